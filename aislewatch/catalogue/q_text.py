"""T1-T15 on document texts, page HTML and product names."""

from pyspark.sql import functions as F

from aislewatch.catalogue.registry import register, with_feed
from aislewatch.functions import text

WS = r"[\s\x{A0}]+"


@register("T1_clean", rf"SELECT doc_id, trim(regexp_replace(text, '{WS}', ' ', 'g')) AS clean_text FROM documents")
def t1(t):
    return t.documents.select("doc_id", text.clean("text").alias("clean_text"))


@register(
    "T2_clean_lines",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', chr(32) || chr(9) || chr(13) || chr(10) || chr(13) || chr(10) || chr(10)),
           '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^[\s\x{A0}]+|[\s\x{A0}]+$', '', 'g') AS clean_text FROM documents""",
)
def t2(t):
    ragged = F.replace("text", F.lit(". "), F.lit(" \t\r\n\r\n\n"))
    return t.documents.select("doc_id", text.clean_lines(ragged).alias("clean_text"))


FRAGMENT_FEED = """
SELECT p_partkey, p_name, p_type, p_size,
  '<div><h2>' || p_name || '</h2><p>Size&nbsp;' || CAST(p_size AS STRING) || ' &amp; more &lt;b&gt; &#38; &#x41;</p><ul><li class="x">' || p_type
  || '</li> <li><b>Brand</b></li></ul>One<br/>Two<script>var t="</p>";</script></div>' AS fragment FROM part
"""


@register(
    "T3_fragment_to_text",
    """SELECT p_partkey, p_name || chr(10) || chr(10) || 'Size ' || p_size || ' & more <b> & A' || chr(10) || chr(10) || '• ' || p_type || chr(10) || '• Brand One' || chr(10) || 'Two' AS plain FROM part""",
)
def t3(t):
    return t.feed(FRAGMENT_FEED).select("p_partkey", text.fragment_to_text("fragment").alias("plain"))


BULLET_FEED = "SELECT p_partkey, p_name, '•- ' || p_name || '   kit -• ' AS line FROM part"


@register("T4_strip_bullets", "SELECT p_partkey, p_name || ' kit' AS line FROM part")
def t4(t):
    return t.feed(BULLET_FEED).select("p_partkey", text.strip_bullets("line").alias("line"))


@register(
    "T5_distinct_lines",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS e,
                 row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY pos) AS lo,
                 row_number() OVER (PARTITION BY doc_id, lower(substr(line, 1, 50)) ORDER BY pos) AS ff,
                 row_number() OVER (PARTITION BY doc_id, lower(regexp_replace(line, '[^\p{L}\p{N}_]+', '', 'g')) ORDER BY pos) AS al FROM l)
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (e = 1) AS exact_text, string_agg(line, chr(10) ORDER BY pos) FILTER (lo = 1) AS lower_text,
           string_agg(line, chr(10) ORDER BY pos) FILTER (ff = 1) AS fifty_text, string_agg(line, chr(10) ORDER BY pos) FILTER (al = 1) AS alphanumeric_text
    FROM r GROUP BY doc_id""",
)
def t5(t):
    items = text.lines("text")
    return t.documents.select(
        "doc_id",
        F.array_join(text.distinct_lines(items, "exact"), "\n").alias("exact_text"),
        F.array_join(text.distinct_lines(items, "lower"), "\n").alias("lower_text"),
        F.array_join(text.distinct_lines(items, "first_fifty"), "\n").alias("fifty_text"),
        F.array_join(text.distinct_lines(items, "alphanumeric"), "\n").alias("alphanumeric_text"),
    )


@register(
    "T6_collapse_repeats",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM l)
    SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS collapsed, count(*) AS n_lines FROM p WHERE before IS DISTINCT FROM line GROUP BY doc_id""",
)
def t6(t):
    kept = text.collapse_repeats(text.lines("text"))
    return t.documents.select(
        "doc_id", F.array_join(kept, "\n").alias("collapsed"), F.size(kept).cast("bigint").alias("n_lines")
    )


RATING_FEED = """
SELECT doc_id, CASE doc_id % 3
   WHEN 0 THEN replace(text, '. ', chr(10) || '4.5 out of 5 stars' || chr(10) || 'x' || chr(10) || '4.5' || chr(10) || '(12)' || chr(10) || '7.25' || chr(10))
   WHEN 1 THEN 'Read 12 Reviews' || chr(10) || 'Read a Review' || chr(10) || '33' || chr(10) || '3.5' || chr(10) || text
   ELSE text || chr(10) || '19' END AS body FROM documents
"""


@register(
    "T7_drop_rating_lines",
    with_feed(
        RATING_FEED,
        r"""SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS body FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id, grp, is_num AND NOT is_rating ORDER BY pos) AS nth FROM (
        SELECT *, sum(CASE WHEN is_rating THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos) AS grp FROM (
          SELECT doc_id, line, pos, regexp_matches(line, '(?i)out of 5 stars|average rating value|Same page link|Read\s+\d+\s+Reviews?|Read a Review') AS is_rating,
                 regexp_matches(trim(line), '^\d+(\.\d+)?$') AS is_num, regexp_matches(trim(line), '^\(?\d+\)?$') AS is_bare
          FROM (SELECT doc_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM feed))))
      WHERE NOT is_rating AND NOT is_bare AND NOT (is_num AND grp > 0 AND nth = 1) GROUP BY doc_id""",
    ),
)
def t7(t):
    kept = text.drop_rating_lines(text.lines("body"))
    return t.feed(RATING_FEED).select("doc_id", F.array_join(kept, "\n").alias("body"))


CTA_FEED = """
SELECT p_partkey, p_name, CASE p_partkey % 4
  WHEN 0 THEN p_name || ' add to wish list now' WHEN 1 THEN p_name || ' Item number: K' || CAST(p_partkey AS STRING) || ' red'
  WHEN 2 THEN p_name || ' Shipping & Returns free for all' ELSE 'Set a reminder ' || p_name || ' Reviews (3)' END AS body FROM part
"""


@register(
    "T8_cut_phrases",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name || ' now' WHEN 1 THEN p_name || ' red' ELSE p_name END AS body FROM part""",
)
def t8(t):
    return t.feed(CTA_FEED).select("p_partkey", text.cut_phrases("body").alias("body"))


AFFIX_FEED = """
SELECT p_partkey, p_name, 'Product code: ' || CAST(p_partkey AS STRING) || ' ' || p_name || ' - QVC UK' AS title, upper(p_name) || ': - fine ' || p_type AS body FROM part
"""


@register("T9_strip_affixes", "SELECT p_partkey, p_name AS title, 'fine ' || p_type AS body FROM part")
def t9(t):
    return t.feed(AFFIX_FEED).select(
        "p_partkey",
        text.strip_affixes("title", r"product code:\s*\w+", r"-\s*(?:QVC|HSN)\b.*").alias("title"),
        text.strip_leading_name("body", "p_name").alias("body"),
    )


BRAND_FEED = """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN NULL ELSE p_brand END AS brand,
       CASE p_partkey % 4 WHEN 1 THEN lower(p_brand) || ' ' || p_name WHEN 2 THEN '' ELSE p_name END AS title FROM part
"""


@register(
    "T10_brand_title",
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN lower(p_brand) || ' ' || p_name WHEN 2 THEN p_brand ELSE p_brand || ' – ' || p_name END AS name FROM part""",
)
def t10(t):
    return t.feed(BRAND_FEED).select("p_partkey", text.brand_title("brand", "title").alias("name"))


@register(
    "T11_first_long_enough",
    r"""SELECT doc_id, coalesce(CASE WHEN length(string_split(text, chr(10))[1]) > 120 THEN string_split(text, chr(10))[1] END,
         CASE WHEN length(string_split(text, chr(10))[2]) > 60 THEN string_split(text, chr(10))[2] END, CASE WHEN length(text) > 200 THEN text END) AS description FROM documents""",
)
def t11(t):
    items = text.lines("text")
    return t.documents.select(
        "doc_id",
        text.first_long_enough(
            [(F.get(items, F.lit(0)), 120), (F.get(items, F.lit(1)), 60), (F.col("text"), 200)]
        ).alias("description"),
    )


@register(
    "T12_longest_specific",
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length(line) DESC, pos) AS n FROM l WHERE NOT regexp_matches(line, '(?i)^(the|der|le)\s'))
    SELECT d.doc_id, r.line AS description FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id AND r.n = 1""",
)
def t12(t):
    picked = text.longest_specific(text.lines("text"), r"(?i)^(the|der|le)\s")
    return t.documents.select("doc_id", picked.alias("description"))


@register(
    "T13_bullets_or_paragraphs",
    r"""SELECT doc_id, CASE WHEN len(bullets) > 0 THEN CASE WHEN len(paras) > 0 THEN paras[1] || chr(10) ELSE '' END || array_to_string(list_transform(bullets, lambda b: '• ' || b), chr(10))
                       ELSE array_to_string(paras[1:3], chr(10)) END AS description
    FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda l: length(l) < 60) AS bullets, list_filter(string_split(text, chr(10)), lambda l: length(l) >= 60) AS paras FROM documents)""",
)
def t13(t):
    items = text.lines("text")
    bullets = F.filter(items, lambda l: F.length(l) < 60)
    paragraphs = F.filter(items, lambda l: F.length(l) >= 60)
    return t.documents.select("doc_id", text.bullets_or_paragraphs(bullets, paragraphs).alias("description"))


@register(
    "T14_title_head",
    rf"SELECT doc_id, trim(regexp_replace(string_split(text, '|')[1], '{WS}', ' ', 'g')) AS head FROM documents",
)
def t14(t):
    return t.documents.select("doc_id", text.title_head("text").alias("head"))


@register(
    "T15_unescape_script",
    """SELECT p_partkey, '{"name":"' || p_name || '&co","a":' || chr(39) || '}' AS script FROM part""",
)
def t15(t):
    slash = F.lit("\\")
    script = F.concat(
        F.lit("{"), slash, F.lit('"name'), slash, F.lit('":'), slash, F.lit('"'), F.col("p_name"), slash, F.lit("u0026co"),
        slash, F.lit('",'), slash, slash, slash, F.lit('"a'), slash, F.lit('":'), slash, F.lit("'}"),
    )
    return t.part.select("p_partkey", text.unescape_script(script).alias("script"))
