"""Edge cases and properties of the operators."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from aislewatch.llm import chat, jaccard, licences, lines, mixing, packing, quality, sketches, suffix_model, token_files
from aislewatch.llm.shared import WORDS, components, shingle_hashes, word_hashes

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "test").collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert found == {x: root(x) for x in parent}


def test_piece_encoder_matches_the_tokenizer():
    known = Tokenizer.from_file(TOKENIZER)
    pieces = token_files.PieceEncoder(TOKENIZER)
    assert pieces.by_piece
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "²", "'s", "'", "...", ".", "!", "the", " ", "\x1c", "　", "x",
             "<|endoftext|>", "日本", "\r\n", "_", "#", "\x85", "🙂", "ª", "́", "\0"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pieces.ids(text) == np.array(known.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_piece_encoder_forgets_and_takes_many_lines(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED_PIECES", 5)
    known = Tokenizer.from_file(TOKENIZER)
    pieces = token_files.PieceEncoder(TOKENIZER)
    for text in ("\n".join(f"line{k}." for k in range(5000)), "a\n\nb\nc, d\n", " ".join(f"w{k % 9}, x.\ny" for k in range(200))):
        assert pieces.ids(text) == np.array(known.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(pieces) <= 5


def test_blanks_after_any_white_space():
    known = Tokenizer.from_file(TOKENIZER)
    pieces = token_files.PieceEncoder(TOKENIZER)
    spaces = [chr(c) for c in range(0x110000) if chr(c).isspace()]
    for space in spaces:
        texts = (f"é{space} b", f"{space} ", f" {space}a, b. é", f"a{space}b é.\nc d", f"a b{space}", f"{space} a b", f"a b{space} c", f"a {space}")
        for text in (*texts, *texts, "", " ", "  ", " a", "a ", "a b\nc d, e"):
            assert pieces.ids(text) == np.array(known.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_totals_are_read_without_the_ids(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k} " * (k % 5)) for k in range(50)], "doc_id bigint, text string")
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(docs, path, TOKENIZER)
    plan = token_files.read_token_files(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert sum("ids#" in line for line in plan.splitlines() if "FileScan orc" in line) == 1


def test_token_files_of_a_repeated_id(spark, tmp_path):
    rows = [(7 if k % 3 else None, f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    token_files.write_token_files(docs, f"file://{tmp_path}/ids", TOKENIZER)
    read = token_files.read_token_files(spark, f"file://{tmp_path}/ids")
    texts = sorted((r.doc_id or -1, r.text) for r in token_files.texts_back(read, TOKENIZER).collect())
    assert texts == sorted((i or -1, t) for i, t in rows)
    starts = [(r.start, len(r.ids)) for r in read.orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    ids = [r.doc_id for r in read.orderBy("start").collect()]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)


def test_token_files_read_back(spark, awkward, empty, tmp_path):
    path = f"file://{tmp_path}/ids"
    token_files.write_token_files(awkward, path, TOKENIZER)
    read = token_files.read_token_files(spark, path)
    texts = sorted((r.doc_id or -1, r.text) for r in token_files.texts_back(read, TOKENIZER).collect())
    assert texts == sorted((r.doc_id or -1, r.text or "") for r in awkward.collect())
    starts = [(r.start, len(r.ids)) for r in read.orderBy("start").collect()]
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    few = token_files.read_token_files(spark, path, [7, 8])
    assert "In(doc_id, [7,8])" in few._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.start for r in few.collect()) == sorted(r.start for r in read.filter("doc_id in (7, 8)").collect())
    token_files.write_token_files(empty, f"{path}-none", TOKENIZER)
    assert token_files.read_token_files(spark, f"{path}-none").count() == 0


def test_escape_round_trip():
    rng = random.Random(2)
    parts = ["#", "##", "###", "### ", "\\", "</turn>", "</", "<", "/", ": ", ":", "a", "\n", "turn>", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        held = chat.escape(text)
        assert chat.unescape(held) == text
        assert "###" not in held and "</turn>" not in held
        role = "".join(rng.choice(parts) for _ in range(rng.randint(0, 4)))
        whole = f"{chat.MARK}{chat.escape_role(role)}{chat.SEP}{held}{chat.END}"
        assert [(r, t) for r, t, _, _ in chat.turns_of(whole * 2)] == [(role, text)] * 2


def test_chat_edge_cases(spark, monkeypatch):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, None, "x" * 5000), (1, 1, "assistant", ""), (None, None, "assistant", "é🙂"),
            (2, 3, "assistant", "b"), (2, None, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'z' AS part")
    parts = chat.format_conversations(turns)
    back = chat.read_conversations(parts).collect()
    held = sorted((r.conv_id or -1, r.role, r.text) for r in back)
    assert held == sorted((c or -1, r or "", t or "") for c, _, r, t in rows)
    for r in parts.collect():
        learned = [chat.unescape(r.text[a:b]) for a, b in zip(r.loss_starts, r.loss_ends, strict=True)]
        assert learned == [t for role, t, _, _ in chat.turns_of(r.text) if role == "assistant"]
    assert [r.text for r in sorted(back, key=lambda r: (r.part, r.position)) if r.conv_id == 2] == ["a", "b"]
    monkeypatch.setattr(chat, "PART_BYTES", 10)
    assert chat.digest_conversations(back_of(turns.limit(0))).count() == 0


def back_of(turns):
    return chat.read_conversations(chat.format_conversations(turns))


def test_sketches(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) for n in (3, 40, 3000, 9000)]
    own = [sketches.sketch_of(t) for t in texts]
    assert [len(s) for s in own] == [1, 36, 256, 256]
    assert sketches.distinct_count(own[3]) == pytest.approx(8996, rel=0.25)
    whole = sketches.sketch_of(texts[2] + " " + texts[3])
    assert sketches.containment(own[2], whole) > 0.85
    table = spark.createDataFrame([(k % 2, s.tolist()) for k, s in enumerate(own)] + [(3, None)], "g int, sketch array<bigint>")
    merged = {r.g: r.sketch for r in sketches.merge_sketches(table, ["g"]).collect()}
    assert merged[0] == sketches.merged(own[0], own[2]).tolist() and merged[1] == sketches.merged(own[1], own[3]).tolist()
    assert merged[3] == []
    pair = spark.createDataFrame([(own[2].tolist(), own[2].tolist())], "a array<bigint>, b array<bigint>")
    assert pair.select(sketches.compare_sketches("a", "b").alias("c")).first().c.resemblance == 1.0


def test_part_keys_lose_no_link():
    rng = np.random.default_rng(5)
    for near in (jaccard.Nearness(3, 90), jaccard.Nearness(5, 80)):
        for size in (*range(1, 40), 63, 100, 257, 1000):
            for _ in range(15):
                union = np.unique(rng.integers(0, 2**64, size + size // 3 + 2, dtype=np.uint64))
                a = union[: max(1, size)]
                drop = rng.integers(0, max(1, size * (100 - near.percent) // 100) + 1)
                b = np.sort(np.concatenate((rng.permutation(a)[drop:], union[size : size + rng.integers(0, drop + 1)])))
                held = len(np.intersect1d(a, b))
                if len(b) and 100 * held >= near.percent * (len(a) + len(b) - held):
                    assert np.intersect1d(jaccard.part_keys(a, near), jaccard.part_keys(b, near)).size


def copies(seed, groups, words=60):
    rng = random.Random(seed)
    rows = []
    for size, changes in groups:
        origin = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(size):
            text = list(origin)
            for _ in range(rng.randint(0, changes)):
                text[rng.randrange(words)] = f"n{rng.randrange(4000)}"
            rows.append((len(rows), " ".join(text), f"s{len(rows) % 3}"))
    return rows


@pytest.mark.parametrize("limit", [1_000_000, 2000])
def test_near_components_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(jaccard, "REGION_SHINGLES", limit)
    rows = copies(6, [(90, 2), (40, 5), (2, 1), (1, 0), (30, 1)])
    near = jaccard.Nearness(5, 80)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r.component_id for r in jaccard.near_components(docs, near).collect()}
    sets = {i: set(shingle_hashes(word_hashes(t), 5).tolist()) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    assert found == {i: root(i) for i in sets}
    kept = sorted(r.doc_id for r in jaccard.keep_one(docs, near).collect())
    assert kept == sorted({root(i) for i in sets})


def test_near_components_edge_cases(spark, awkward, empty):
    found = jaccard.near_components(awkward).collect()
    assert len(found) == awkward.count()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by[1]] == [1, 1] and by[6][0].component_id == 5
    assert by[2][0].n_shingles == by[3][0].n_shingles == by[4][0].n_shingles == 0
    assert (by[3][0].component_id, by[None][0].component_id) == (3, None)
    assert jaccard.near_components(empty).count() == 0
    assert jaccard.keep_one(awkward).columns == awkward.columns


def test_edit_distance():
    rng = random.Random(7)
    for _ in range(600):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, before = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
        assert edit_of(a, b) == row[-1]
        most = rng.randint(0, 6)
        assert min(lines.edit_distance(a, b, most), most + 1) == min(row[-1], most + 1)


def edit_of(a, b):
    return lines.edit_distance(a, b, 100)


def test_hamming_blocks_lose_no_pair(spark):
    rng = random.Random(8)
    hashes = [rng.getrandbits(64) for _ in range(60)]
    for h in hashes[:40]:
        near = h
        for bit in rng.sample(range(64), rng.randint(1, 3)):
            near ^= 1 << bit
        hashes.append(near)
    table = spark.createDataFrame([(h - (1 << 64) if h >> 63 else h,) for h in hashes], "sim bigint")
    found = {r.node: r.root for r in lines.sim_families(table).collect()}
    for a in hashes:
        for b in hashes:
            if a != b and (a ^ b).bit_count() <= 3:
                x, y = (h - (1 << 64) if h >> 63 else h for h in (a, b))
                assert found[x] == found[y]


def majority(hashes):
    """The SimHash by counting bits one by one."""
    values = hashes.tolist()
    return sum(1 << bit for bit in range(64) if 2 * sum(v >> bit & 1 for v in values) > len(values))


def test_simhashes_of_short_and_long_lines():
    rng = np.random.default_rng(15)
    sizes = [2, 3, 255, 256, 257, 40, 7, 1000]
    words = rng.integers(0, 2**64, sum(sizes), dtype=np.uint64)
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    found = lines.simhashes(words, begins, np.array(sizes))
    same = lambda a, b: majority(words[a : a + b]) in (int(x) for x in found)
    assert all(same(a, b) for a, b in zip(begins, sizes, strict=True))


def test_word_scan_finds_words_and_tells_them_apart(monkeypatch):
    rng = random.Random(16)
    parts = ["a", "b", "A", "é", "  ", " ", "\n", "\x0b", "\x85", "\u3000", "🙂", "0", "\0"]
    known = {}
    for chunk in (1 << 18, 8):
        monkeypatch.setattr(type(WORDS), "CHUNK", chunk)
        for _ in range(1500):
            text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
            words = text.encode().lower().split()
            hashes = word_hashes(text).tolist()
            assert len(words) == len(hashes)
            for w, h in zip(words, hashes, strict=True):
                assert known.setdefault(w, h) == h
    assert len(set(known.values())) == len(known)


def brute_dedup(rows):
    """Lines of each document that stay, all pairs compared."""
    held = []
    for i, text, _ in rows:
        for k, line in enumerate(lines.normal_lines(text)):
            if len(line) >= lines.LEAST_WORDS:
                content = b" ".join(line).decode()
                held.append((i, k, content, majority(word_hashes(content))))
    group = list(range(len(held)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for x in range(len(held)):
        for y in range(x):
            a, b = held[x], held[y]
            if a[2] == b[2] or ((a[3] ^ b[3]).bit_count() <= lines.RADIUS and lines.similar(a[2].split(), b[2].split())):
                p, q = root(x), root(y)
                group[max(p, q)] = min(p, q)
    gone = {(i, k) for x, (i, k, _, _) in enumerate(held) if root(x) != x}
    return {i: "\n".join(s for k, s in enumerate(t.split("\n")) if (i, k) not in gone) for i, t, _ in rows}


@pytest.mark.parametrize("limit", [50_000, 8])
def test_dedup_lines_by_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(lines, "FAMILY_LINES", limit)
    single = copies(9, [(12, 1), (6, 2), (3, 0), (5, 1)], words=45)
    texts = [t for _, t, _ in single]
    rng = random.Random(10)
    rows = [(i, "\n".join([*rng.choices(texts, k=4), f"own line number {i} of many", "", "Page 3", "x"]), "s") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == brute_dedup(rows)


def test_dedup_lines_edge_cases(spark, awkward, empty):
    found = lines.dedup_lines(awkward)
    assert found.columns == awkward.columns and found.count() == awkward.count()
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts[2] is None and texts[3] == "" and texts[6] == "" and texts[4] == " \t\n "
    left = lines.dedup_lines(awkward, drop_emptied=True)
    assert left.filter("doc_id = 6").count() == 0 and left.filter("doc_id = 3").count() == 1
    assert lines.dedup_lines(empty).count() == 0


MIT = next(t.text for t in licences.TEMPLATES if t.label == "mit")


def labels_of(text, idf=None):
    return {m[0] for m in licences.PositionalIndex(idf or {}).find(licences.licence_words(text))}


def test_index_finds_altered_templates():
    altered = MIT.replace("any person", "every human person").replace("merge, publish,", "publish,")
    for text in (MIT, "Foo bar. " + altered.upper() + " more text", "x " * 50 + MIT):
        assert labels_of(text) == {"mit"}
    assert labels_of("This code is released under the MIT-License! Enjoy.") == {"mit"}
    assert labels_of("Text licensed under CC-BY-NC 4.0") == {"cc-by", "cc-by-nc"}
    assert not labels_of("by the public general license rights all")
    index = licences.PositionalIndex({})
    assert [m[2] for m in index.find(licences.licence_words("cc by cc by")) if m[1]] == [0, 2]


def test_a_mention_is_not_a_licence():
    for text in (
        "Our photos come from creative commons sources", "he hated the MIT license", "the mozilla public license is a public license",
        "a boost software license and an apache license version 2 0", "copies or substantial portions of the software were lost",
        "gnu affero general public license",
    ):
        assert not labels_of(text) - {"gpl"}
    for t in licences.PositionalIndex({}).templates:
        assert t.base or (len(t.pairs) >= 2 and t.coverage(t.key, -t.key_at) < licences.LEAST_COVERAGE)


def test_matches_by_brute_force():
    """Every template at every place of its key phrase, without an index."""
    rng = random.Random(8)
    texts = [t.text for t in licences.TEMPLATES]
    common = [w for t in texts for w in t.split()]
    for k in range(150):
        parts = []
        for _ in range(rng.randint(1, 5)):
            words = rng.choice(texts).split()
            for _ in range(rng.randint(0, len(words) // 2)):
                place = rng.randrange(len(words))
                words[place : place + rng.randint(0, 1)] = rng.sample(common, rng.randint(0, 2))
                words = words or ["x"]
            parts += words + rng.choices(common, k=rng.randint(0, 9))
        words = licences.licence_words(" ".join(parts))
        idf = {w: rng.random() for w in {x for t in texts for x in licences.licence_words(t)}} if k % 2 else {}
        index = licences.PositionalIndex(idf)
        expected = set()
        for t in index.templates:
            for at in range(len(words) - len(t.key) + 1):
                start = at - t.key_at
                near = sum(any(words[i] == t.words[p] for i in range(start + p - t.drift, start + p + t.drift + 1) if 0 <= i < len(words)) for p in t.places)
                if words[at : at + len(t.key)] == t.key and near >= t.need:
                    share = t.coverage(words, start)
                    if share >= licences.LEAST_COVERAGE:
                        expected.add((t.label, t.base, at, len(t.key), share))
        assert set(index.find(words)) == expected


def test_licences_edge_cases(awkward, empty):
    found = licences.scan_licences(awkward, into="region").collect()
    assert len(found) == awkward.count()
    assert {r.doc_id: r.region.n_words for r in found}[2] == 0
    assert licences.scan_licences(empty).count() == 0


def test_flight_keeps_sums():
    rng = np.random.default_rng(11)
    size = rng.integers(1, 900, 500).astype(float)
    psi = np.full(500, 0.37)
    out = mixing.flight(psi, size, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(psi.sum()) and (out * size).sum() == pytest.approx((psi * size).sum())
    assert set(np.unique(mixing.landing(out, size))) <= {0.0, 1.0}


def test_mix_rounds_and_edge_cases(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_UNITS", 8)
    rows = [(i, "w " * (i % 7 + 1), "hot" if i % 3 else f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mixing.mix_plan(docs).collect()
    assert sorted(r.doc_id for r in plan) == list(range(400))
    taken, target = Counter(), {}
    for r in plan:
        taken[r.source] += r.copies * r.size
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 14 for s in target)
    assert Counter(r.doc_id for r in mixing.mix(docs).collect()) == Counter({r.doc_id: r.copies for r in plan if r.copies})
    assert mixing.mix(awkward).columns == awkward.columns
    assert mixing.mix_plan(awkward).count() == awkward.select("doc_id", "source").distinct().count()
    assert mixing.mix_plan(empty).count() == 0


def test_best_fit_takes_the_tightest_compatible_bin():
    rng = random.Random(12)
    items = sorted(((rng.randint(1, 60), rng.randrange(5), rng.randrange(12)) for _ in range(300)), reverse=True)
    places = packing.best_fit(*map(list, zip(*items, strict=True)), 100, 2)
    bins = []
    for (size, source, cluster), place in zip(items, places, strict=True):
        fits = [
            (100 - sum(s for s, _, _ in b), k) for k, b in enumerate(bins)
            if sum(s for s, _, _ in b) + size <= 100 and cluster not in {c for _, _, c in b} and sum(x == source for _, x, _ in b) < 2
        ]
        assert place == (min(fits)[1] if fits else len(bins))
        if place == len(bins):
            bins.append([])
        bins[place].append((size, source, cluster))


def test_pack_holds_every_word(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 16)
    found = packing.pack(awkward, capacity=1000).collect()
    assert sum(r.n_words for r in found) == sum(len((r.text or "").encode().split()) for r in awkward.collect())
    load, seen = Counter(), Counter()
    for r in found:
        load[r.bin] += r.n_words
        seen[r.bin, r.cluster] += 1
    assert max(load.values()) <= 1000 and max(seen.values()) == 1
    assert {r.doc_id for r in found} == {r.doc_id for r in awkward.collect()}
    assert packing.pack(empty).count() == 0


def test_suffix_model_distributions_sum_to_one(spark, awkward, empty, monkeypatch):
    monkeypatch.setattr(suffix_model, "LEAST_CONTEXT", 0.01)
    rng = random.Random(13)
    text = lambda: " ".join(x for _ in range(60) for x in rng.choice((("a", "b", "c"), ("a", "d"), ("e", "b", "f"))))
    docs = spark.createDataFrame([(i, text()) for i in range(40)], "doc_id bigint, text string")
    model = suffix_model.train(docs)
    tree = model.tree
    assert len(tree.parents) > 3
    for context in ("a", "a b", "e b", "zzz", "c a"):
        total = 0.0
        for word in ("a", "b", "c", "d", "e", "f", None):
            last = np.array([suffix_model.END], np.uint64) if word is None else word_hashes(word)
            hashes = np.concatenate((word_hashes(context), last))
            total += 10 ** tree.log_scores(tree.numbers(hashes))[0][-1]
        unknown = tree.log_scores(tree.numbers(word_hashes(context + " nobody")))[0][-1]
        total += 10**unknown * 0.5 / (model.train_tokens + 0.5 * (model.distinct + 1))
        assert total == pytest.approx(1.0, abs=1e-6)
    scored = suffix_model.score(docs, model, ["doc_id"]).collect()
    assert sum(r.score for r in scored) > 0.6 * sum(r.base_score for r in scored)
    odd = suffix_model.score(awkward, model, awkward.columns)
    assert odd.count() == awkward.count() and {r.doc_id: r.n_tokens for r in odd.collect()}[2] == 1
    assert suffix_model.score(empty, model, ["doc_id"]).count() == 0
    assert suffix_model.train(empty).train_tokens == 0


def test_texts_are_scored_together_as_each_alone(spark, monkeypatch):
    monkeypatch.setattr(suffix_model, "LEAST_CONTEXT", 0.01)
    rng = random.Random(17)
    texts = [" ".join(rng.choice(("a b c", "a d", "e b f", f"x{rng.randrange(30)}")) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["", " \n", "a", "a b", "b c"]
    model = suffix_model.train(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    tree = model.tree
    scans, scan = [], suffix_model.WORDS.scan
    monkeypatch.setattr(suffix_model.WORDS, "scan", lambda data: scans.append(1) or scan(data))
    found = suffix_model._judged(tree, texts).to_pylist()
    assert len(scans) == 1
    for text, row in zip(texts, found, strict=True):
        hashes = np.append(word_hashes(text), suffix_model.END)
        numbers = tree.numbers(hashes)
        scores, open_ = tree.log_scores(numbers)
        words, counts = np.unique(hashes[open_].view(np.int64), return_counts=True)
        assert (row["n_tokens"], row["n_known"]) == (len(hashes), (numbers >= 0).sum())
        assert (row["open_words"], row["open_counts"]) == (words.tolist(), counts.tolist())
        assert row["score"] == pytest.approx(scores.sum(), rel=1e-12, abs=1e-12)
        assert row["base_score"] == pytest.approx(tree.word_log[numbers[numbers >= 0]].sum(), rel=1e-12, abs=1e-12)


def suffix_scores(texts, scored):
    """Scores of texts by the model of ``texts``, from counts in dictionaries."""
    tokens = lambda t: [*word_hashes(t).tolist(), int(suffix_model.END)]
    n = Counter()
    for ws in map(tokens, texts):
        n.update(tuple(ws[i : i + k]) for k in range(1, suffix_model.DEPTH + 2) for i in range(len(ws) - k + 1))
    total, distinct = sum(c for g, c in n.items() if len(g) == 1), sum(len(g) == 1 for g in n)
    base = lambda w: (n[w,] + 0.5) / (total + 0.5 * (distinct + 1))
    after = {}
    for g, m in n.items():
        if len(g) > 1 and m >= suffix_model.LEAST_COUNT:
            after.setdefault(g[:-1], {})[g[-1]] = m
    events, backoff = {}, {}

    def probability(context, word):
        if not context:
            return base(word)
        if word in events.get(context, ()):
            return events[context][word]
        return backoff.get(context, 1.0) * probability(context[1:], word)

    for context in sorted(after, key=len):
        suffix = {w: probability(context[1:], w) for w in after[context]}
        own = {w: (m + suffix_model.PRIOR * suffix[w]) / (n[context] + suffix_model.PRIOR) for w, m in after[context].items()}
        rest, weight = 1 - sum(own.values()), (1 - sum(own.values())) / (1 - sum(suffix.values()))
        if sum(p * np.log(p / suffix[w]) for w, p in own.items()) + rest * np.log(weight) >= suffix_model.LEAST_DIVERGENCE:
            events[context], backoff[context] = own, weight
    assert any(len(c) == suffix_model.DEPTH for c in events)
    return [sum(np.log10(probability(tuple(ws[max(0, i - suffix_model.DEPTH) : i]), w)) for i, w in enumerate(ws)) for ws in map(tokens, scored)]


@pytest.mark.parametrize("context, event", [(1e-5, 2e-6), (2.0, 2.0), (0.02, 0.004)])
def test_suffix_model_learns_all_contexts_that_occur_twice(spark, monkeypatch, context, event):
    """Whether they make up a share of the corpus or not: what is not in the tree is looked up."""
    monkeypatch.setattr(suffix_model, "LEAST_CONTEXT", context)
    monkeypatch.setattr(suffix_model, "LEAST_EVENT", event)
    rng = random.Random(23)
    text = lambda: " ".join(x for _ in range(rng.randrange(40)) for x in rng.choice((("a", "b", "c"), ("a", "d"), ("e", "b", "f"), (f"x{rng.randrange(60)}",))))
    rare = " ".join(f"rare{k}" for k in range(25))
    texts = [text() for _ in range(80)] + [rare, rare, None, "", "a", "once " + rare[:30]]
    scored = [*texts, *(text() for _ in range(20)), "rare3 rare4 rare5 rare6", "never seen words"]
    model = suffix_model.train(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    found = suffix_model.score(spark.createDataFrame(list(enumerate(scored)), "doc_id bigint, text string"), model, ["doc_id"])
    found = {r.doc_id: r for r in found.collect()}
    wanted = suffix_scores([t or "" for t in texts], [t or "" for t in scored])
    assert len(found) == len(scored)
    for k, score in enumerate(wanted):
        assert found[k].score == pytest.approx(score, rel=1e-9), (k, scored[k])
    assert found[80].score > 0.6 * found[80].base_score


def test_quality_rejects_noise_and_repetition(awkward, empty):
    rng = random.Random(14)
    compressor = zstandard.ZstdCompressor(level=quality.LEVEL)
    prose = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) + str(rng.randrange(99)) for _ in range(900))
    noise = " ".join("".join(chr(rng.randrange(0x21, 0x7F)) for _ in range(40)) for _ in range(400))
    reasons = [quality.measure(t, compressor, quality.BANDS)[-1] for t in (prose, noise, "same words " * 900, "")]
    assert reasons == [None, "incompressible", "repetitive", "empty"]
    kept = quality.keep_good(awkward)
    assert kept.columns == awkward.columns
    assert quality.with_quality(awkward).count() == awkward.count()
    assert quality.keep_good(empty).count() == 0


def test_fingerprint_edge_cases(spark, awkward, empty):
    found = sketches.compare_with_edited(awkward).collect()
    assert len(found) == awkward.count()
    assert {r.doc_id: r.near_next for r in found}[5] == 1.0
    assert sketches.compare_with_edited(empty).count() == 0
    one = sketches.compare_with_edited(spark.createDataFrame([(4, "a b c d")], "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(4, 1.0)]
