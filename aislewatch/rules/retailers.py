"""Which shop a host belongs to, and its country."""

from __future__ import annotations

# Host without ``www.``, retailer key, country code.
RETAILERS: tuple[tuple[str, str, str], ...] = (
    ("binglee.com.au", "binglee", "AU"),
    ("harveynorman.com.au", "harveynorman", "AU"),
    ("kgelectronic.com.au", "kgelectronic", "AU"),
    ("kitchenware.com.au", "kitchenware", "AU"),
    ("nightingalecc.com.au", "nightingale", "AU"),
    ("templeandwebster.com.au", "templeandwebster", "AU"),
    ("woolworths.com.au", "woolworths", "AU"),
    ("cdon.se", "cdon", "SE"),
    ("fyndiq.se", "fyndiq", "SE"),
    ("allegro.pl", "allegro", "PL"),
    ("cdiscount.com", "cdiscount", "FR"),
    ("kaufland.de", "kaufland", "DE"),
    ("diy.com", "bandq", "GB"),
    ("ao.com", "ao", "GB"),
    ("argos.co.uk", "argos", "GB"),
    ("boots.com", "boots", "GB"),
    ("currys.co.uk", "currys", "GB"),
    ("houseoffraser.co.uk", "frasers", "GB"),
    ("freemans.com", "freemans", "GB"),
    ("jdwilliams.co.uk", "jdwilliams", "GB"),
    ("laredoute.co.uk", "laredoute", "GB"),
    ("ligo.co.uk", "ligo", "GB"),
    ("next.co.uk", "next", "GB"),
    ("qvcuk.com", "qvc_uk", "GB"),
    ("therange.co.uk", "range", "GB"),
    ("studio.co.uk", "studio", "GB"),
    ("tesco.com", "tesco", "GB"),
    ("very.co.uk", "very", "GB"),
    ("wayfair.co.uk", "wayfair_uk", "GB"),
    ("wilko.com", "wilko", "GB"),
    ("amazon.com", "amazon", "US"),
    ("homedepot.com", "homedepot", "US"),
    ("hsn.com", "hsn", "US"),
    ("jcpenney.com", "jcpenney", "US"),
    ("macys.com", "macys", "US"),
    ("overstock.com", "overstock", "US"),
    ("qvc.com", "qvc", "US"),
    ("target.com", "target", "US"),
    ("walmart.com", "walmart", "US"),
    ("wayfair.com", "wayfair", "US"),
    ("zola.com", "zola", "US"),
)

# Languages whose stock phrases a country's pages use, its own first.
LANGUAGES = {"SE": ("sv", "en"), "PL": ("pl", "en"), "FR": ("fr", "en"), "DE": ("de", "en")}
