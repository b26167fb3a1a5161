"""Text: escapes, formats, codes, and coarse families of browsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns, in the order in which they are tried.
BROWSERS = (
    ("Bot", r"(?i)bot|crawl|spider|slurp|headlesschrome|facebookexternalhit|curl|wget|monitoring"),
    ("Edge", r"(?i)edg(e|a|ios)?/"),
    ("Samsung Internet", r"(?i)samsungbrowser/"),
    ("Opera", r"(?i)opr/|opios/|opera"),
    ("Firefox", r"(?i)firefox/|fxios/"),
    ("Chrome", r"(?i)(chrome|chromium|crios)/"),
    ("Safari", r"(?i)safari/"),
)
SYSTEMS = (("Android", r"(?i)android"), ("iOS", r"(?i)iphone|ipad|ipod|ios/"), ("macOS", r"(?i)mac os x|macintosh"), ("Windows", r"(?i)windows"), ("Linux", r"(?i)linux|x11|cros"))
SEGMENT = r"^[a-z][a-z0-9-]{0,31}$"
CONTENT_TYPES = {"json": "application/json", "pmtiles": "application/octet-stream", "png": "image/png"}


def clean(value: Column) -> Column:
    """Null for null and for a not-a-number that stands for a missing text."""
    return F.when(value.isNull() | (F.lower(value) == "nan"), None).otherwise(value)


def fallback_name(*names: Column) -> Column:
    return F.coalesce(*names)


def decode_escapes(text: Column) -> Column:
    """%<hex>% stands for a code point."""
    parts = F.split(F.regexp_replace(text, "%([0-9a-fA-F]+)%", "\x00%$1\x00"), "\x00")
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^%[0-9a-fA-F]+$"), _char(F.conv(F.substring(p, 2, 8), 16, 10).cast("int"))).otherwise(p)), "")


def _char(code: Column) -> Column:
    """The text of a code point: chr() ends at 255, so its UTF-8 bytes are put together."""
    byte = lambda shift, mark: F.lpad(F.hex(F.shiftright(code, shift).bitwiseAND(63).bitwiseOR(mark).cast("long")), 2, "0")
    lead = lambda shift, mark: F.lpad(F.hex(F.shiftright(code, shift).bitwiseOR(mark).cast("long")), 2, "0")
    raw = (
        F.when(code < 128, F.lpad(F.hex(code.cast("long")), 2, "0"))
        .when(code < 2048, F.concat(lead(6, 192), byte(0, 128)))
        .when(code < 65536, F.concat(lead(12, 224), byte(6, 128), byte(0, 128)))
        .otherwise(F.concat(lead(18, 240), byte(12, 128), byte(6, 128), byte(0, 128)))
    )
    return F.decode(F.unhex(raw), "UTF-8")


def parse_tags(field: Column) -> Column:
    """A map from "key=value,key=value" with escapes; the last of equal keys holds; an empty field has none."""
    items = F.filter(F.split(F.coalesce(field, F.lit("")), ","), lambda x: x != "")
    entry = lambda x: F.struct(decode_escapes(F.regexp_extract(x, "^([^=]*)", 1)).alias("key"), decode_escapes(F.regexp_extract(x, "^[^=]*=?(.*)$", 1)).alias("value"))
    entries = F.transform(items, entry)
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def parse_members(field: Column) -> Column:
    """An array of (kind, ref, role) from "w123@outer,n5@label"."""
    items = F.filter(F.split(F.coalesce(field, F.lit("")), ","), lambda x: x != "")
    return F.transform(
        items, lambda x: F.struct(F.substring(x, 1, 1).alias("kind"), F.regexp_extract(x, r"^.(\d+)", 1).cast("long").alias("ref"), decode_escapes(F.regexp_extract(x, "@(.*)$", 1)).alias("role"))
    )


def checksum(line: Column) -> Column:
    """The first run of 32 hexadecimal digits, in lower case; empty for none."""
    return F.lower(F.regexp_extract(line, r"\b([0-9a-fA-F]{32})\b", 1))


def poly_url(url: Column) -> Column:
    """The outline's address beside an extract's."""
    return F.when(url.rlike(r"-latest\.osm\.pbf$"), F.regexp_replace(url, r"-latest\.osm\.pbf$", ".poly")).otherwise(F.raise_error(F.lit("not an extract")))


def total_size(content_range: Column) -> Column:
    """The total of a Content-Range header; null where it isn't known."""
    found = F.regexp_extract(content_range, r"/(\d+)\s*$", 1)
    return F.when(found != "", found.cast("long"))


def content_type(path: Column) -> Column:
    found = F.lit("application/octet-stream")
    for suffix, kind in CONTENT_TYPES.items():
        found = F.when(F.substring_index(path, ".", -1) == suffix, kind).otherwise(found)
    return found


def detail_stem(scenario: Column, lat: Column, lon: Column) -> Column:
    return F.format_string("%s-%.6f_%.6f", scenario, lat, lon)


def snapshot_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def _fixed(value: Column, digits: int) -> Column:
    """Half up at a number of digits, with commas between thousands."""
    return F.format_number(F.floor(value * 10**digits + 0.5) / 10**digits, digits)


def fmt_dist(m: Column) -> Column:
    """Steps of 10 m under a kilometre, one digit under 9.95 km, whole kilometres above."""
    tens = F.floor(m / 10 + 0.5) * 10
    km = m / 1000
    return F.when(tens < 1000, F.concat(tens.cast("string"), F.lit(" m"))).when(km < 9.95, F.concat(_fixed(km, 1), F.lit(" km"))).otherwise(F.concat(_fixed(km, 0), F.lit(" km")))


def fmt_km_exact(m: Column) -> Column:
    return F.coalesce(F.concat(_fixed(m / 1000, 2), F.lit(" km")), F.lit(""))


def fmt_km2(km2: Column) -> Column:
    return F.when(km2.isNull(), "").when(km2 < 9.95, F.concat(_fixed(km2, 1), F.lit(" km²"))).otherwise(F.concat(_fixed(km2, 0), F.lit(" km²")))


def flag(code: Column) -> Column:
    """The two regional indicators of a two-letter code; empty for others."""
    point = lambda k: _char(F.ascii(F.substring(F.upper(code), k, 1)) - 65 + 0x1F1E6)
    return F.when(code.rlike("^[A-Za-z]{2}$"), F.concat(point(1), point(2))).otherwise("")


def _family(ua: Column, rules: tuple) -> Column:
    found = F.when(F.coalesce(ua, F.lit("")) == "", "Other")
    for name, pattern in rules:
        found = found.when(ua.rlike(pattern), name)
    return found.otherwise("Other")


def browser_family(ua: Column) -> Column:
    return _family(ua, BROWSERS)


def os_family(ua: Column) -> Column:
    return _family(ua, SYSTEMS)


def landing(path: Column) -> Column:
    """page, region and unit of "/", "/region" or "/region/unit"; any other path isn't a page."""
    raw = F.filter(F.split(F.regexp_replace(path, "/+$", ""), "/"), lambda x, i: i > 0)
    parts = F.transform(raw, lambda s: F.lower(F.try_url_decode(F.replace(s, F.lit("+"), F.lit("%2B")))))
    fine = (F.size(parts) <= 2) & F.forall(parts, lambda s: F.coalesce(s.rlike(SEGMENT), F.lit(False)))
    at = lambda k: F.when(fine, F.coalesce(F.get(parts, F.lit(k)), F.lit(""))).otherwise("")
    return F.struct(fine.alias("page"), at(0).alias("region"), at(1).alias("unit"))


def visitor_code(country: Column, region: Column) -> Column:
    c, r = F.upper(F.coalesce(country, F.lit(""))), F.upper(F.coalesce(region, F.lit("")))
    return F.when(~c.rlike("^[A-Z]{2}$"), "").when(r.rlike("^[A-Z0-9]{1,3}$"), F.concat_ws("-", c, r)).otherwise(c)


def hex_rgb(color: Column) -> Column:
    """[red, green, blue] of #rgb or #rrggbb."""
    h = F.regexp_replace(F.trim(color), "^#", "")
    h = F.when(F.length(h) == 3, F.regexp_replace(h, "(.)", "$1$1")).otherwise(h)
    return F.array(*[F.conv(F.substring(h, k, 2), 16, 10).cast("int") for k in (1, 3, 5)])


def html_escape(text: Column) -> Column:
    # The characters and what stands for them.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text
