"""HTML to relations (H).

A page is parsed once into ``dom``: its elements in document order and its text pieces. Selectors
are then filters over that array inside the page's own row, so no selector shuffles. ``node_table``
turns the elements into an ordinary table when one is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewatch.functions.text import bind, clean
from aislewatch.session import spread

NODE_SCHEMA = (
    "struct<node:int,parent:int,last:int,pos:int,tag:string,attrs:map<string,string>,t_from:int,t_to:int>"
)
DOM_SCHEMA = f"struct<nodes:array<{NODE_SCHEMA}>,texts:array<string>>"

_ARROW_DOM = pa.struct(
    [
        ("nodes", pa.list_(pa.struct([
            ("node", pa.int32()), ("parent", pa.int32()), ("last", pa.int32()), ("pos", pa.int32()), ("tag", pa.string()),
            ("attrs", pa.map_(pa.string(), pa.string())), ("t_from", pa.int32()), ("t_to", pa.int32()),
        ]))),
        ("texts", pa.list_(pa.string())),
    ]
)

# Fixed values of the HTML standard: elements without content, and start tags that end an open one.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    **{t: {"p"} for t in "p div ul ol dl table section article h1 h2 h3 h4 h5 h6 form footer header nav".split()},
}
_SLICE = 64
_SILENT = frozenset(("script", "style", "template"))


class _Tree(HTMLParser):
    """Collect elements and text pieces of one page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.texts: list[str] = []
        self.open: list[int] = []
        self.children: dict[int, int] = {}

    def _close(self, depth: int) -> None:
        for index in self.open[depth:]:
            self.nodes[index]["last"] = len(self.nodes) - 1
            self.nodes[index]["t_to"] = len(self.texts)
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        ends = _CLOSES.get(tag, ())
        if self.open and self.nodes[self.open[-1]]["tag"] in ends:
            self._close(len(self.open) - 1)
        unique = {}
        for name, value in attrs:
            unique.setdefault(name, value or "")
        n, at = len(self.nodes), len(self.texts)
        parent = self.open[-1] if self.open else -1
        pos = self.children[parent] = self.children.get(parent, 0) + 1
        self.nodes.append({
            "node": n, "parent": parent, "last": n, "pos": pos, "tag": tag,
            "attrs": list(unique.items()), "t_from": at, "t_to": at,
        })
        if tag not in _VOID:
            self.open.append(n)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.nodes[self.open[depth]]["tag"] == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        piece = " ".join(data.split())
        if piece and not (self.open and self.nodes[self.open[-1]]["tag"] in _SILENT):
            self.texts.append(piece)


def _parse(html: str | None) -> dict | None:
    if html is None:
        return None
    tree = _Tree()
    tree.feed(html)
    tree.close()
    tree._close(0)
    return {"nodes": tree.nodes, "texts": tree.texts}


@dataclass(frozen=True)
class Probe:
    """What else is read from a page while it is parsed: a column ``name`` of type ``ddl``.

    ``read`` gets the row's kept columns in ``needs``, the raw page and its tree.
    """

    name: str
    ddl: str
    arrow: pa.DataType
    needs: tuple[str, ...]
    read: Callable[[Mapping, str, Mapping], object]


def parse_pages(
    pages: DataFrame,
    html: str = "html",
    keep: Sequence[str] | None = None,
    balance: bool = True,
    probes: Sequence[Probe] = (),
    error: str | None = None,
) -> DataFrame:
    """H1: add ``dom`` and drop the raw HTML, which nothing after this stage needs.

    Arrow batches go to the tokeniser and come back; rows stay in their partition unless the
    input is too small to occupy the cluster; ``balance=False`` if the caller has seen to that.
    ``probes`` add a column each. With ``error`` a page on which the tokeniser or a probe fails does not end
    the job: its ``dom`` and probes are NULL and the column ``error`` says what happened, else it is NULL.
    """
    kept = list(keep) if keep is not None else [c for c in pages.columns if c != html]
    source = pages.select(*kept, F.col(html).alias("_html"))
    added = ["dom", *(p.name for p in probes), *([error] if error else [])]
    kinds = [_ARROW_DOM, *(p.arrow for p in probes), *([pa.string()] if error else [])]
    needs = sorted({c for p in probes for c in p.needs})

    def one(page: str | None, row: Mapping) -> tuple:
        if page is None:
            return (None,) * len(added)
        try:
            tree = _parse(page)
            found = (tree, *(p.read(row, page, tree) for p in probes))
        except Exception as failure:
            if error is None:
                raise
            return (*(None,) * (len(added) - 1), f"{type(failure).__name__}: {failure}"[:500])
        return (*found, None) if error else found

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Trees are larger than their pages, so they leave in slices of few pages.
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                rows = part.select(needs).to_pylist() if needs else [{}] * part.num_rows
                found = [one(h, r) for h, r in zip(part.column(len(kept)).to_pylist(), rows, strict=True)]
                arrays = [pa.array([f[k] for f in found], type=kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(kept))] + arrays, names=kept + added)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
    fields += [f"dom {DOM_SCHEMA}", *(f"`{p.name}` {p.ddl}" for p in probes), *([f"`{error}` string"] if error else [])]
    source = spread(source) if balance else source
    return source.mapInArrow(tokenise, ", ".join(fields))


def node_table(parsed: DataFrame, key: str) -> DataFrame:
    """One row per element: (key, node, parent, last, pos, tag, id, classes, attrs, t_from, t_to).

    ``node`` numbers the elements in document order and ``last`` is the last one inside; ``pos`` counts the
    elements of one parent from 1; the element's text pieces are those after ``t_from`` up to ``t_to``.
    """
    node = F.col("n")
    return parsed.select(key, F.explode("dom.nodes").alias("n")).select(
        key,
        *[node[c].alias(c) for c in ("node", "parent", "last", "pos", "tag")],
        node["attrs"]["id"].alias("id"),
        classes_of(node).alias("classes"),
        node["attrs"].alias("attrs"),
        node["t_from"].alias("t_from"),
        node["t_to"].alias("t_to"),
    )


def text_table(parsed: DataFrame, key: str) -> DataFrame:
    """One row per text piece: (key, at, text), pieces counted from 1 in document order."""
    pieces = parsed.select(key, F.posexplode("dom.texts").alias("at", "text"))
    return pieces.select(key, (F.col("at") + 1).alias("at"), "text")


def classes_of(node: Column) -> Column:
    return F.filter(F.split(F.coalesce(node["attrs"]["class"], F.lit("")), r"\s+"), lambda c: c != "")


def select(
    nodes: Column,
    tag: str | Iterable[str] | None = None,
    id: str | None = None,
    cls: str | None = None,
    attrs: Mapping[str, str] | None = None,
    contains: Mapping[str, str] | None = None,
    starts: Mapping[str, str] | None = None,
    has: Iterable[str] = (),
    within: Column | None = None,
) -> Column:
    """H2: elements by tag, id, class and attribute tests, and optionally inside given elements."""

    def test(n: Column) -> Column:
        checks = []
        if tag is not None:
            tags = [tag] if isinstance(tag, str) else list(tag)
            checks.append(n["tag"].isin(*tags))
        if id is not None:
            checks.append(n["attrs"]["id"] == id)
        if cls is not None:
            checks.append(F.array_contains(classes_of(n), cls))
        checks += [n["attrs"][k] == v for k, v in (attrs or {}).items()]
        checks += [n["attrs"][k].contains(v) for k, v in (contains or {}).items()]
        checks += [n["attrs"][k].startswith(v) for k, v in (starts or {}).items()]
        checks += [n["attrs"][k].isNotNull() for k in has]
        out = F.lit(True)
        for check in checks:
            out = out & F.coalesce(check, F.lit(False))
        return out

    if within is None:
        return F.filter(nodes, test)
    return bind(within, lambda w: F.filter(nodes, lambda n: test(n) & F.exists(w, lambda a: inside(n, a))))


def inside(node: Column, ancestor: Column) -> Column:
    """Elements are numbered in document order, so descent is a range test."""
    return (node["node"] > ancestor["node"]) & (node["node"] <= ancestor["last"])


def first(nodes: Column) -> Column:
    return F.get(nodes, F.lit(0))


def text_of(dom: Column, node: Column) -> Column:
    """H3: text of an element, pieces joined by a blank, white space collapsed."""
    pieces = F.slice(dom["texts"], node["t_from"] + 1, node["t_to"] - node["t_from"])
    return F.when(node.isNotNull(), F.array_join(pieces, " "))


def page_text(dom: Column) -> Column:
    return F.array_join(dom["texts"], " ")


def attr(node: Column, *names: str) -> Column:
    """H4: first non-empty attribute of a fallback chain."""
    return F.coalesce(*[F.nullif(F.trim(node["attrs"][n]), F.lit("")) for n in names])


def image_address(node: Column) -> Column:
    """Lazy-loading chain; of a ``srcset`` the first address."""
    chain = attr(node, "data-src", "data-original", "src", "srcset")
    return F.split_part(F.trim(F.split_part(chain, F.lit(","), F.lit(1))), F.lit(" "), F.lit(1))


def meta(dom: Column, *names: str) -> Column:
    """H6: content of the first named meta element, by ``property``, ``name`` or ``itemprop``."""

    def one(name: str) -> Column:
        hits = F.filter(
            dom["nodes"],
            lambda n: (n["tag"] == "meta")
            & F.coalesce(
                (n["attrs"]["property"] == name) | (n["attrs"]["name"] == name) | (n["attrs"]["itemprop"] == name),
                (n["attrs"]["property"] == name), (n["attrs"]["name"] == name), (n["attrs"]["itemprop"] == name),
                F.lit(False),
            ),
        )
        return attr(first(hits), "content")

    return F.coalesce(*[one(n) for n in names])


def product_name(dom: Column, site: Column | None = None, jsonld: Column | None = None, default: str | None = None) -> Column:
    """H5: site selector, ``h1``, JSON-LD, ``og:title``, title up to a bar, default."""

    def filled(text: Column) -> Column:
        return F.nullif(clean(text), F.lit(""))

    title = text_of(dom, first(select(dom["nodes"], tag="title")))
    tries = [
        filled(site) if site is not None else None,
        filled(text_of(dom, first(select(dom["nodes"], tag="h1")))),
        filled(jsonld) if jsonld is not None else None,
        filled(meta(dom, "og:title")),
        filled(F.split_part(title, F.lit("|"), F.lit(1))),
        F.lit(default) if default else None,
    ]
    return F.coalesce(*[t for t in tries if t is not None])


def specification_lines(dom: Column) -> Column:
    """H7: ``Name: Value`` for table rows with two cells and for ``dt``/``dd`` pairs, in page order."""
    cells = lambda row: select(dom["nodes"], tag=("th", "td"), within=F.array(row))
    rows = F.transform(
        select(dom["nodes"], tag="tr"),
        lambda r: bind(
            cells(r),
            lambda c: F.when(
                F.size(c) >= 2, F.concat_ws(": ", text_of(dom, F.get(c, F.lit(0))), text_of(dom, F.get(c, F.lit(1))))
            ),
        ),
    )
    terms = select(dom["nodes"], tag="dt")
    pairs = F.transform(
        terms,
        lambda d: F.concat_ws(
            ": ",
            text_of(dom, d),
            text_of(
                dom,
                first(F.filter(dom["nodes"], lambda n: (n["tag"] == "dd") & (n["parent"] == d["parent"]) & (n["node"] > d["node"]))),
            ),
        ),
    )
    return F.array_compact(F.concat(rows, pairs))


def without_clones(nodes: Column, clone_class: str) -> Column:
    """H8: drop carousel clones."""
    return F.filter(nodes, lambda n: ~F.array_contains(classes_of(n), clone_class))


def gallery_order(dom: Column, container: Column) -> Column:
    """H9: displays in page order, then thumbnails by the k of "k of N" (100 + k, 199 when unnumbered)."""
    images = select(dom["nodes"], tag="img", within=container)
    buttons = select(dom["nodes"], tag="button", within=container)

    def ranked(all_buttons: Column) -> Column:
        def rank(img: Column, i: Column) -> Column:
            owner = first(F.filter(all_buttons, lambda b: inside(img, b)))
            k = F.nullif(F.regexp_extract(owner["attrs"]["aria-label"], r"(?i)(\d+)\s+of\s+\d+", 1), F.lit(""))
            order = F.when(owner.isNull(), i).otherwise(F.coalesce(k.cast("int"), F.lit(99)) + 100)
            return F.struct(order.alias("order"), i.alias("pos"), image_address(img).alias("url"))

        return F.sort_array(F.transform(images, rank))

    return bind(buttons, ranked)


def background_url(style: Column) -> Column:
    """Address inside ``url(...)`` of a style attribute."""
    return F.nullif(F.regexp_extract(style, r"""url\(\s*["']?(.*?)["']?\s*\)""", 1), F.lit(""))
