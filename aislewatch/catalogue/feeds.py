"""Feeds: plain SELECTs over the given tables, meaning the same in Spark SQL and in the oracle.

The tables hold no retail pages, so the retail text of each operator is rendered from their rows.
Every feed covers its whole table.
"""

# Product base: cents, and the price split in whole and fraction.
PRODUCT = """
SELECT p_partkey, p_name, p_brand, p_type, p_size, cents,
       CAST(floor(cents / 100) AS BIGINT) AS whole,
       lpad(CAST(cents % 100 AS STRING), 2, '0') AS frac,
       CAST(floor(cents / 100000) AS BIGINT) AS thousands,
       lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS STRING), 3, '0') AS units
FROM (SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
             CAST(round(p_retailprice * 100) AS BIGINT) AS cents FROM part)
"""

# Price text in eight renderings.
PRICE_TEXT = f"""
SELECT p_partkey, cents, whole, frac,
  CASE p_partkey % 8
    WHEN 0 THEN '$' || CASE WHEN thousands > 0 THEN CAST(thousands AS STRING) || ',' || units ELSE CAST(whole AS STRING) END || '.' || frac
    WHEN 1 THEN 'Now £' || CAST(whole AS STRING) || '.' || frac
    WHEN 2 THEN CASE WHEN thousands > 0 THEN CAST(thousands AS STRING) || '.' || units ELSE CAST(whole AS STRING) END || ',' || frac || ' €'
    WHEN 3 THEN '€' || CAST(whole AS STRING) || '.' || frac
    WHEN 4 THEN CASE WHEN thousands > 0 THEN CAST(thousands AS STRING) || ' ' || units ELSE CAST(whole AS STRING) END || ',' || frac || ' kr'
    WHEN 5 THEN 'cena ' || CAST(whole AS STRING) || ' , ' || frac || ' zł'
    WHEN 6 THEN CAST(cents AS STRING)
    ELSE NULL END AS price_text
FROM ({PRODUCT})
"""

# Image URL lists: one page per product, three shots in three sizes, the small ones first.
IMAGE_LIST = """
SELECT page_id, p_brand, p_type, p_size, size_no * 3 + n AS pos, n, px,
       'https://cdn.example/p/' || CAST(page_id AS STRING) || '/' || px || 'x' || px || '/'
       || replace(p_brand, '#', '') || '_' || CAST(n AS STRING)
       || CASE WHEN page_id % 4 = 0 THEN '.PNG' ELSE '.jpg' END || '?wid=' || px AS url
FROM (SELECT page_id, p_brand, p_type, p_size, n, size_no, CASE size_no WHEN 0 THEN '115' WHEN 1 THEN '400' ELSE '700' END AS px
      FROM (SELECT page_id, p_brand, p_type, p_size, CAST(1 + i % 3 AS BIGINT) AS n, CAST(floor(i / 3) AS BIGINT) AS size_no
            FROM (SELECT p_partkey AS page_id, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, explode(sequence(0, 8)) AS i FROM part)))
"""

# The same with images from order lines: page = order, family = brand, number = line number.
ORDER_IMAGES = """
SELECT l_orderkey AS page_id, l_partkey AS part_id,
       CAST(l_linenumber AS BIGINT) AS n, replace(p_brand, '#', '') AS family,
       CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey * 1000 + l_suppkey AS pos,
       CAST(l_quantity AS BIGINT) AS quantity, l_returnflag, l_linestatus,
       'https://cdn.example/original/' || lower(p_type) || '/' || replace(p_brand, '#', '') || '/'
       || replace(p_brand, '#', '') || '_' || CAST(l_linenumber AS STRING) || '.jpg' AS url
FROM lineitem JOIN part ON p_partkey = l_partkey
"""

# Product pages: one page per product, with the parts missing on some of them.
RETAIL_PAGE = f"""
SELECT p_partkey AS page_id, p_name, p_brand, p_type, p_size, cents, whole, frac,
  'https://www.shop.example/p/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS STRING) AS url,
  '<!DOCTYPE html><html><head><title>' || p_name || ' | Shop</title>'
  || CASE WHEN p_partkey % 4 <> 1 THEN '<meta property="og:title" content="' || p_name || ' og">' ELSE '' END
  || CASE WHEN p_partkey % 5 = 0 THEN '<meta property="og:price:amount" content="' || CAST(whole AS STRING) || '.' || frac || '">' ELSE '' END
  || '<meta name="description" content="About ' || p_name || '">'
  || CASE WHEN p_partkey % 3 = 0 THEN '<script type="application/ld+json">{{"@type":"Product","name":"' || p_name || ' ld","sku":"' || CAST(p_partkey AS STRING)
       || '","offers":{{"@type":"Offer","price":"' || CAST(whole AS STRING) || '.' || frac || '","priceCurrency":"USD","availability":"https://schema.org/'
       || CASE WHEN p_partkey % 2 = 0 THEN 'InStock' ELSE 'OutOfStock' END || '"}}}}' || CASE WHEN p_partkey % 6 = 0 THEN ',' ELSE '' END || '</script>' ELSE '' END
  || '<style>p{{margin:0}}</style></head><body><!-- top --><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>'
  || CASE WHEN p_partkey % 6 <> 1 THEN '<h1 class="product title" id="t">' || p_name || ' <b>' || p_brand || '</b></h1>' ELSE '' END
  || CASE WHEN p_partkey % 2 = 0 THEN '<div data-testid="price" class="price now">$' || CAST(whole AS STRING) || '.' || frac || '</div>' ELSE '' END
  || '<button data-cy="pdp-add-to-cart"' || CASE WHEN p_partkey % 7 = 0 THEN ' disabled' ELSE '' END || '>Add to cart</button>'
  || '<ul class="glide"><li class="glide__slide glide__slide--clone"><img src="c3.jpg"></li>'
  || '<li class="glide__slide"><img data-src="" data-original="a' || CAST(p_partkey AS STRING) || '.jpg" src="x.gif"></li>'
  || '<li class="glide__slide"><img srcset="b' || CAST(p_partkey AS STRING) || '.jpg 300w, b2.jpg 600w"></li></ul>'
  || '<div id="grid"><button aria-label="' || CAST(1 + p_partkey % 2 AS STRING) || ' of 2"><img src="t1.jpg"></button><button aria-label="' || CAST(2 - p_partkey % 2 AS STRING)
  || ' of 2"><img src="t2.jpg"></button><img src="m.jpg"></div>'
  || '<table><tr><th>Brand</th><td>' || p_brand || '</td></tr><tr><td>Size</td><td>' || CAST(p_size AS STRING) || '</td></tr><tr><td>lonely</td></tr></table>'
  || '<dl><dt>Type</dt><dd>' || p_type || '</dd></dl>'
  || '<div class="hero" style="color:red;background-image: url(https://cdn.example/h' || CAST(p_partkey AS STRING) || '.jpg)"></div>'
  || '<p>First &amp; best<p>Second</body></html>' AS html
FROM ({PRODUCT})
"""

# Captures in eight conditions: product, missing, category, redirected, listing data, and so on.
CAPTURE = """
SELECT p_partkey AS page_id, p_name, p_brand, CAST(p_partkey % 8 AS BIGINT) AS kind,
  'https://shop.example/produkt/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey AS STRING) || '/' AS url,
  CASE p_partkey % 8 WHEN 3 THEN 'https://shop.example/hemmet/kok/' WHEN 0 THEN 'https://shop.example/produkt/x/' WHEN 7 THEN CASE WHEN p_partkey % 3 = 0 THEN 'https://shop.example/' END END AS final_url,
  CAST(CASE WHEN p_partkey % 24 = 15 THEN 404 ELSE 200 END AS INT) AS http_status,
  '<html><head><title>' || p_name || '</title></head><body>' || CASE p_partkey % 8
   WHEN 0 THEN '<script type="application/ld+json">{"@type": "Product", "name": "' || p_name || '", "offers": {"price": "1"}}</script><h1>' || p_name || ' 404</h1><p>Sidan finns inte alltid</p><button data-cy="pdp-add-to-cart">K</button>'
   WHEN 1 THEN '<h1 class="a">Ooops! Sidan finns inte längre :(</h1><img alt="404">'
   WHEN 2 THEN '<nav role="navigation" aria-label="Paginering"><a aria-label="Gå till sida 1" href="/c/?page=1">1</a><a aria-label="Gå till sida 2" href="/c/?page=2">2</a><a aria-label="Gå till sida 3" href="/c/?page=3">3</a></nav><div data-testid="product-card">a</div><div data-testid="product-card">b</div><h1>Kettles & toasters</h1><p>1,234 Items</p>'
   WHEN 3 THEN '<div class="product-grid">12 produkter</div><div aria-label="Produktbeskrivning">x</div><div class="product-card">1</div><div class="product-card">2</div><div class="product-card">3</div><div class="product-card">4</div>'
   WHEN 4 THEN '<script type="application/ld+json">{"@type": "ItemList"}</script><div id="error-page">x</div>'
   WHEN 5 THEN '<p>' || repeat('lorem ', 100) || 'Av alla hittade du till en sida som inte finns mer. Page not found. Captcha' || repeat(' ipsum', 100) || '</p>'
   WHEN 6 THEN '<p>pris 1 hittade du till en sida som inte finns mer. Page not found</p>'
   ELSE '<p>' || p_brand || '</p>' END || '</body></html>' AS html
FROM part
"""
