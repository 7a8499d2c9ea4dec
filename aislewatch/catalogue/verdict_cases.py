"""Pages of each shop with rules of its own, and the verdict each must get. NAME stands for a product's name."""

from __future__ import annotations

from typing import NamedTuple


class Case(NamedTuple):
    retailer: str
    url: str
    html: str
    valid: bool
    reason: str


def _data(extra: str = "") -> str:
    return f'<script type="application/ld+json">{{"@type": "Product", "name": "NAME"{extra}}}</script>'


def _many(n: int, html: str) -> str:
    return html * n


_NO_PRODUCT_PAGE = "URL is a category/listing page, not a product page"
_NO_STRUCTURE = "Product page structure not found - product may have been removed"

CASES = (
    Case("next", "https://www.next.co.uk/style/1", '<h1>NAME</h1><div data-testid="image-carousel-slide">x</div><p>Add to bag</p>', True, "valid"),
    Case("next", "https://www.next.co.uk/shop/1", '<div data-testid="plp-product-title"><h1>NAME sets</h1></div>', False, "category_page:NAME sets"),
    Case("next", "https://www.next.co.uk/shop/2", '<div class="plp-list">x</div>', False, "category_page:unknown"),
    Case("next", "https://www.next.co.uk/shop/3", '<span class="esi-count">( 12 )(142)</span>', False, "product_listing:( 12 )(142)"),
    Case("next", "https://www.next.co.uk/search?w=x", "<h1>NAME</h1>", False, "search_results_page"),
    Case("next", "https://www.next.co.uk/style/2", "<p>Sorry, this product is no longer available today</p>", False, "error_message:this product is no longer avai"),
    Case("next", "https://www.next.co.uk/style/3", '<div class="x"><b class="MyNotFoundBox">x</b></div>', False, "error_element:[class*='NotFound']"),
    Case("next", "https://www.next.co.uk/style/4", _many(3, '<div class="product-tile">x</div>'), False, "product_grid:3_items"),
    Case("next", "https://www.next.co.uk/style/5", "<h1>Women's shoes</h1>", False, "category_title:women's shoes"),
    Case("frasers", "https://www.houseoffraser.co.uk/a-1", '<h1>NAME</h1><button data-testid="purchase-button">Buy</button>', True, "valid"),
    Case("frasers", "https://www.houseoffraser.co.uk/a-2", '<section data-testid="error-view">x</section>', False, "error_element:[data-testid='error-view']"),
    Case("frasers", "https://www.houseoffraser.co.uk/a-3", '<h1>NAME</h1><div class="ProductListing">x</div>', False, "category_page:[class*='ProductListing']"),
    Case("frasers", "https://www.houseoffraser.co.uk/a-4", "<h2>NAME</h2>", False, "no_product_content"),
    Case("jdwilliams", "https://www.jdwilliams.co.uk/p/1", "<h1>NAME</h1><span class='price'>1</span>", True, "valid"),
    Case("jdwilliams", "https://www.jdwilliams.co.uk/p/2", _many(4, '<i class="x product-card">y</i>'), False, "category_page:4_products"),
    Case("jdwilliams", "https://www.jdwilliams.co.uk/p/3", '<h1>NAME</h1><a href="/search?q=1">back</a>', False, "redirected_to_search"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-1.aspx", '<h1 class="pdp-title">NAME</h1><span class="price">1</span><div class="swipe">x</div>', True, "valid"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-2.aspx", "<p>Nous sommes désolés</p>", False, "error_message:nous sommes désolés"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-3.aspx", _many(5, '<b class="product-tile">x</b>'), False, "listing_page:5_cards"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-4.aspx", '<div class="plp-content">' + _many(6, '<a href="/ppdp/prod-9.aspx">x</a>') + "</div>", False, "listing_page:0_cards"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-5.aspx", '<span class="price">1</span>', False, "no_pdp_content:1_indicators"),
    Case("laredoute", "https://www.laredoute.co.uk/ppdp/prod-6.aspx", '<span class="price">1</span><div class="swipe">x</div>', False, "no_product_name"),
    Case("very", "https://www.very.co.uk/a/1601066433.prd", '<b data-testid="product_brand">B</b><b data-testid="product_title">NAME</b><button>Add  to basket</button><div class="splide">x</div>', True, "valid"),
    Case("very", "https://www.very.co.uk/a/1601066433.prd", '<b data-testid="product_brand">B</b><b data-testid="product_title">NAME</b><div class="splide">x</div>', False, "id_not_found:1601066433"),
    Case("very", "https://www.very.co.uk/a/1601066433.prd", _many(2, '<b class="product-card">x</b>') + _many(2, '<b class="product-tile">x</b>'), False, "listing_page:4_products"),
    Case("very", "https://www.very.co.uk/a/1601066433.prd", '<ul class="pagination">x</ul><p>20 items</p>', False, "listing_page:pagination_found"),
    Case("ligo", "https://ligo.co.uk/products/a", '<h1 class="product__title">NAME</h1><span class="price">1</span>', True, "valid"),
    Case("ligo", "https://ligo.co.uk/products/b", '<div id="shopify-section-404">x</div>', False, "shopify_404_template"),
    Case("ligo", "https://ligo.co.uk/products/c", _many(2, '<b class="product-card">x</b>') + '<b class="grid-product">x</b>', False, "collection_page:3_products"),
    Case("ligo", "https://ligo.co.uk/products/d", '<nav aria-label="next page">x</nav>', False, "listing_page:pagination_found"),
    Case("studio", "https://www.studio.co.uk/a", '<b id="lblProductName">NAME</b><b id="lblSellingPrice">1</b><a class="zoomMainImage" href="x.jpg">z</a>', True, "valid"),
    Case("studio", "https://www.studio.co.uk/b", '<div class="error-main">Sorry, it no longer exists</div>', False, "error_page_not_found"),
    Case("studio", "https://www.studio.co.uk/c", _many(6, '<a href="/view-1.html">x</a>'), False, "listing_page:0_products"),
    Case("studio", "https://www.studio.co.uk/d", '<b id="lblProductName"> </b><b id="lblSellingPrice">1</b>', False, "no_product_name"),
    Case("boots", "https://www.boots.com/a-1", '<h1 id="estore_product_title">NAME</h1><b class="price">1</b>', True, "valid"),
    Case("boots", "https://www.boots.com/a-2", '<div id="WC_GenericError_5">It has been removed</div>', False, "product_removed_error_div"),
    Case("boots", "https://www.boots.com/a-3", "<p>This product has either been removed or is no longer available for sale.</p>", False, "error_message:this product has either been removed or "),
    Case("boots", "https://www.boots.com/a-4", "<p>NAME</p>", False, "no_product_content"),
    Case("boots", "https://www.boots.com/a-5", '<b class="price">1</b><i class="paging">1</i>' + _many(3, '<b class="product-card">x</b>'), False, "category_page:3_products"),
    Case("freemans", "https://www.freemans.com/x/A-77X974", '<h1 id="prodShortDesc">NAME</h1><b class="productPrice">1</b>', True, "valid"),
    Case("freemans", "https://www.freemans.com/x/A-77X974", '<h1 id="prodShortDesc">NAME</h1><b class="productPrice" data-product="12Y345">1</b>', False, "code_mismatch:expected_77X974"),
    Case("freemans", "https://www.freemans.com/x/A-77X974", _many(3, '<a class="productLink">x</a>'), False, "listing_page:0_tiles"),
    Case("freemans", "https://www.freemans.com/x/A-77X974", "<p>48 products found</p>", False, "listing_page:pagination_found"),
    Case("wilko", "https://www.wilko.com/p/123", '<div class="pdp-price">1</div>', True, "valid"),
    Case("wilko", "https://www.wilko.com/en/c/456", '<div class="pdp-price">1</div>', False, _NO_PRODUCT_PAGE),
    Case("wilko", "https://www.wilko.com/p/124", '<main><div class="alert">This product is not available</div></main>', False, "Product is no longer available"),
    Case("wilko", "https://www.wilko.com/p/125", '<div class="product-discontinued">Gone for good</div>', False, "Gone for good"),
    Case("wilko", "https://www.wilko.com/p/126", "<p>NAME</p>", False, _NO_STRUCTURE),
    Case("wilko", "https://www.wilko.com/x", "<p>NAME</p>", False, "Page does not contain expected product detail elements"),
    Case("tesco", "https://www.tesco.com/groceries/1", "<h1>NAME</h1>" + _data(), True, "valid"),
    Case("tesco", "https://www.tesco.com/groceries/2", '<div class="M90PRG_container">Not down this aisle</div>', False, "error_page:tesco_not_found"),
    Case("tesco", "https://www.tesco.com/groceries/3", "<h1>Oops</h1>", False, "error_page:h1_error"),
    Case("tesco", "https://www.tesco.com/groceries/4", "<p>Sorry, this page does not exist</p>", False, "error_page:pattern_match"),
    Case("tesco", "https://www.tesco.com/groceries/5", _many(4, '<b data-auto="product-tile">x</b>'), False, "listing_page:4_product_tiles"),
    Case("tesco", "https://www.tesco.com/groceries/6", "<h1>NAME</h1>", False, "missing_pdp_elements:score_1/3"),
    Case("qvc_uk", "https://www.qvcuk.com/x.product.1.html", '<h1>NAME</h1><button id="btnAddToCart">Add</button>', True, "valid"),
    Case("qvc_uk", "https://www.qvcuk.com/x.product.2.html", "<h1>Oops!</h1><h2>We cannot find it</h2>", False, "error_page:oops_404"),
    Case("qvc_uk", "https://www.qvcuk.com/x.product.3.html", "<h1>Oops!</h1>", False, "error_page:oops_header"),
    Case("qvc_uk", "https://www.qvcuk.com/x.product.4.html", '<div class="paging">' + _many(3, "<a>1</a>") + "</div>", False, "listing_page:pagination_3_pages"),
    Case("qvc_uk", "https://www.qvcuk.com/category/x", '<h1>NAME</h1><b class="price">1</b>', False, "url_pattern:category_or_search"),
    Case("ao", "https://ao.com/product/x.aspx", '<h1 id="pageTitle">NAME</h1>', True, "valid"),
    Case("ao", "https://ao.com/l/kettles", '<h1 id="pageTitle">NAME</h1>', False, _NO_PRODUCT_PAGE),
    Case("ao", "https://ao.com/product/y.aspx", '<h1 id="pageTitle">NAME</h1><p>1,204 results</p>', False, _NO_PRODUCT_PAGE),
    Case("ao", "https://ao.com/product/z.aspx", "<main>We no longer stock this</main>", False, "Product has been discontinued"),
    Case("ao", "https://ao.com/product/w.aspx", "<p>NAME</p>", False, _NO_STRUCTURE),
    Case("currys", "https://www.currys.co.uk/products/x-10203040.html", "<h1>NAME</h1>" + _data(), True, "Valid: Product schema found"),
    Case("currys", "https://www.currys.co.uk/products/x-10203040.html", '<h1>A long name of a product, NAME</h1><div class="pdp-container"><img src="https://media.currys.biz/i/10203040_a"></div>', True, "Valid: Product detail page with images"),
    Case("currys", "https://www.currys.co.uk/laptops", "<h1>Gaming Laptops</h1>", False, "Category page detected (H1='Gaming Laptops', no Product schema)"),
    Case("currys", "https://www.currys.co.uk/x", _many(3, '<b class="product-card">x</b>') + '<i class="filter-panel">f</i>', False, "Category page detected (multiple products + filters)"),
    Case("currys", "https://www.currys.co.uk/products/x-10203040.html", "<h1>A long name of a product, NAME</h1>", False, "No product data found for PID 10203040"),
    Case("currys", "https://www.currys.co.uk/x", "<h1>Hello</h1>", False, "No product content found (H1='Hello')"),
    Case("cdiscount", "https://www.cdiscount.com/a/f-1-x.html", "<h1>Le NAME bleu</h1>", True, "valid"),
    Case("cdiscount", "https://www.cdiscount.com/a/f-2-x.html", '<script>x={"currentSceneContext":{"a":1,"contentType":"SHOWCASE"}}</script>', False, "page_type:SHOWCASE"),
    Case("cdiscount", "https://www.cdiscount.com/a/l-12.html", _data(', "offers": {"price": 1}'), False, "listing_url"),
    Case("cdiscount", "https://www.cdiscount.com/a", _many(4, '<article class="one product">x</article>'), False, "listing_page:4_products"),
    Case("cdiscount", "https://www.cdiscount.com/a", "<p>Produit introuvable</p>", False, "error_message:produit introuvable"),
    Case("cdiscount", "https://www.cdiscount.com/a", "<p>NAME</p>", False, "no_product_signs"),
    Case("cdon", "https://cdon.se/produkt/a-1/", "<h1>NAME</h1>" + _data(), True, "Valid: has JSON-LD Product schema"),
    Case("cdon", "https://cdon.se/produkt/a-2/", '<nav aria-label="Paginering">' + _many(3, '<a aria-label="Gå till sida 1">1</a>') + "</nav>", False, "Invalid: pagination with 3 pages (category page)"),
    Case("cdon", "https://cdon.se/hem/", "<h1>NAME</h1>", False, "Invalid: URL doesn't contain /produkt/"),
    Case("cdon", "https://cdon.se/produkt/a-3/", "<h1>NAME</h1>", True, "Uncertain: defaulting to valid"),
    Case("allegro", "https://allegro.pl/oferta/a-1", "<h1>NAME</h1>", True, "valid"),
    Case("allegro", "https://allegro.pl/oferta/a-2", "<p>Ups, nic tu nie ma</p>", False, "404 - Page not found"),
    Case("allegro", "https://allegro.pl/oferta/a-3", '<a href="/">h</a><a href="/pomoc">p</a>', False, "404 - Page not found (navigation pattern)"),
    Case("allegro", "https://allegro.pl/oferta/a-4", "<h1>NAME</h1><p>Sprzedaż zakończona</p>", False, "Listing ended (Sprzedaż zakończona)"),
    Case("allegro", "https://allegro.pl/oferta/a-5", "<h1>NAME</h1><h6>Oferta została zakończona</h6>", False, "Listing ended (h6 header)"),
    Case("allegro", "https://allegro.pl/oferta/a-6", "<h1>NAME</h1><p>Produkt niedostępny</p>", False, "Product unavailable"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/pdp/a.html", '<h1>NAME</h1><b data-test-id="AddToCartButton">Add</b>', True, "valid"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/kitchen-c123456.html", "<h1>NAME</h1>", False, "category_url_pattern"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/x", "<p>1,164 Items</p>", False, "listing_page:1164_items"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/x", "<h1>Mixers & Attachments</h1><p>1 Result</p>", False, "category_title:mixers & attachments"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/x", '<div class="ProductGrid">' + _many(3, '<b class="ProductCard">x</b>') + "</div>", False, "product_grid:3_cards"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/pdp/b.html", "<h2>NAME</h2>", False, "pdp_url_redirected_to_category"),
    Case("wayfair_uk", "https://www.wayfair.co.uk/x", '<h2>NAME</h2><b data-test-id="ProductSku">1</b>', False, "insufficient_pdp_indicators:1"),
)
