"""The registered queries against brute-force versions, on the smallest data folder."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(spark, folder, name, key="doc_id"):
    return {r[key]: r for r in entry_module.queries()[name](spark, folder).collect()}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, width):
    w = words(text)
    return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute_components(sets, percent):
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in sorted(sets) if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def test_all_eleven_are_registered():
    names = entry_module.queries()
    assert [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")].__len__() == 10
    assert "pipeline" in names


def test_fingerprints(spark, folder, documents):
    found = rows(spark, folder, "op1_fingerprints")
    errors = []
    for k, (i, text, _) in enumerate(documents):
        following = documents[(k + 1) % len(documents)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = shingles(text, 5)
        errors += [abs(r.near_edited - jaccard(own, shingles(edited, 5))), abs(r.near_next - jaccard(own, shingles(following, 5)))]
    assert len(found) == len(documents)
    assert max(errors) < 0.15 and float(np.mean(errors)) < 0.02


def test_jaccard(spark, folder, documents):
    found = rows(spark, folder, "op2_jaccard")
    sets = {i: shingles(text, 3) for i, text, _ in documents}
    expected = brute_components(sets, 90)
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == {i: (len(s), expected[i]) for i, s in sets.items()}


def test_chat(spark, folder):
    found = rows(spark, folder, "op3_chat", "conv_id")
    turns = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    said = "\\### Assistant: </turn> ok"
    held = [(r.conv_id, r.turn, r.role, r.text or "") for r in turns] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    by = {}
    for conv, _, role, text in sorted(held, key=lambda r: r[:2]):
        by.setdefault(conv, []).append((role, text))
    for conv, told in by.items():
        learned = "".join(t for r, t in told if r == "assistant")
        r = found[conv]
        assert r.n_turns == len(told)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in told).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars > sum(len(t) for _, t in told)
    assert set(found) == set(by)


def test_suffix_model(spark, folder, documents):
    found = rows(spark, folder, "op4_suffix_model")
    tokens = {i: [*words(t), None] for i, t, _ in documents}
    held_out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held_out[i] for w in ws)
    total = sum(counts.values())
    smooth = total + 0.5 * (len(counts) + 1)
    for i, ws in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held_out[i], len(ws), total)
        assert r.n_known == sum(counts[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / smooth) for w in ws))
        assert r.score < 0
    out = [r for r in found.values() if r.held_out]
    # Held-out accuracy: the tree predicts texts it has not seen better than single tokens do.
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_licences(spark, folder, documents):
    found = rows(spark, folder, "op7_licences")
    base = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    for i, text, _ in documents:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        places = [
            (k, label) for phrase, label in base.items() for k in range(len(w)) if w[k : k + len(phrase.split())] == phrase.split()
        ]
        r = found[i]
        starts = [k for k, _ in places]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_token_files(spark, folder, documents):
    found = rows(spark, folder, "op8_token_files")
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for i, text, _ in documents:
        ids = [*known.encode(text or "", add_special_tokens=False).ids, 2]
        r = found[i]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(found) == len(documents)


def test_mix(spark, folder, documents):
    found = rows(spark, folder, "op9_mix")
    sizes = {i: len(WORD.findall(t or "")) for i, t, _ in documents}
    source_of = {i: s for i, _, s in documents}
    total = Counter()
    for i, n in sizes.items():
        total[source_of[i]] += n
    names = sorted((s for s in total if s is not None)) + ([None] if None in total else [])
    weights = {s: 1 + k % 3 for k, s in enumerate(names)}
    everything, target, open_ = sum(total.values()), {}, set(names)
    while open_:
        left = everything - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * total[s]}
        target |= {s: 3 * total[s] for s in over} if over else share
        open_ = open_ - over if over else set()
    taken = Counter()
    largest = max(sizes.values())
    for i, n in sizes.items():
        r = found[i]
        assert (r.size, r.source_size) == (n, total[source_of[i]])
        assert r.target == pytest.approx(target[source_of[i]])
        assert 0 <= r.taken <= 3 * n and (n == 0 or r.taken % n == 0)
        taken[source_of[i]] += r.taken
    for s in names:
        assert abs(taken[s] - target[s]) <= largest
    again = rows(spark, folder, "op9_mix")
    assert {i: r.taken for i, r in again.items()} == {i: r.taken for i, r in found.items()}


def test_quality(spark, folder, documents):
    found = rows(spark, folder, "op10_quality")
    for i, text, _ in documents:
        text = text or ""
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, repeats = set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                repeats += line in seen
                seen.add(line)
        r = found[i]
        symbols = sum(text.count(c) for c in "#*$%&|<>")
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), symbols)
        assert (r.n_dup_lines, r.n_repeat_words) == (repeats, len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.kept and r.base_failed)
        if not r.base_failed and 1.3 < r.whole_ratio < 4:
            assert r.kept
