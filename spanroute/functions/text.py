"""Expressions over names, URLs, lists and codes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Legal forms that names of companies end in; fixed values of the domain.
LEGAL = ["ag", "co", "gmbh", "inc", "llc", "ltd", "plc", "sa", "sl", "spa", "srl"]
SHAPE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)((?s).*)$"
#: Texts of a batch that are taken apart together.
SLICE = 64
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
#: Causes of failed reads, tried in this order: words of the text, cause.
CAUSES = [
    (["not a zip file", "not an archive"], "not-an-archive"), (["ceiling", "over the"], "oversize"), (["certificate", "ssl", "tls"], "tls"), (["timed out", "timeout"], "timeout"),
    (["getaddrinfo", "name or service", "nodename"], "dns"), (["scheme", "blocked", "not fetched"], "blocked_url"), (["unreachable", "transport"], "transport"),
]
PERMISSIVE = ["Apache-2.0", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "MIT", "ODC-BY-1.0"]


def identity_url(url: Column) -> Column:
    """The URL if it has a scheme and a host, else null; surrounding space isn't trimmed."""
    return F.when(url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#@]*@)?[^/?#@:]+(:[0-9]*)?([/?#]|$)"), url)


def host_of(url: Column) -> Column:
    authority = F.regexp_extract(url, SHAPE, 2)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))
    return F.nullif(host, F.lit(""))


def last_segment(url: Column) -> Column:
    """The last part of the path that isn't empty, lower-cased."""
    path = F.rtrim(F.regexp_extract(url, SHAPE, 3), F.lit("/"))
    return F.nullif(F.lower(F.element_at(F.split(path, "/"), -1)), F.lit(""))


def match_url(url: Column) -> Column:
    """The form in which URLs are compared.

    Scheme and host in lower case, http as https, without a default port and one slash at
    the path's end; user, path, query and fragment stay.
    """
    kept = identity_url(url)
    scheme, authority, path, tail = (F.regexp_extract(kept, SHAPE, i) for i in range(1, 5))
    user, host = F.regexp_extract(authority, "^(.*@)?", 0), F.lower(F.regexp_replace(authority, "^.*@", ""))
    default = F.when(F.lower(scheme) == "http", ":0*80$").when(F.lower(scheme) == "https", ":0*443$")
    host = F.when(default.isNotNull(), F.regexp_replace(host, default, "")).otherwise(host)
    scheme = F.when(F.lower(scheme) == "http", "https").otherwise(F.lower(scheme))
    return F.concat(scheme, F.lit("://"), user, host, F.regexp_replace(path, "/$", ""), tail)


def claims(scope: Column, url: Column) -> Column:
    """Whether ``scope``, a URL, claims ``url``: the same scheme, host and port, and its path's segments first."""
    def parts(u: Column) -> tuple[Column, Column]:
        kept = match_url(u)
        origin = F.concat(F.regexp_extract(kept, SHAPE, 1), F.lit("://"), F.regexp_replace(F.regexp_extract(kept, SHAPE, 2), "^.*@", ""))
        return origin, F.filter(F.split(F.regexp_extract(kept, SHAPE, 3), "/"), lambda s: s != "")

    (o1, s1), (o2, s2) = parts(scope), parts(url)
    return (o1 == o2) & (F.slice(s2, F.lit(1), F.size(s1)) == s1)


def name_tokens(name: Column) -> Column:
    """Distinct words of letters and digits in lower case without legal forms, sorted; for text without accents."""
    words = F.regexp_extract_all(F.lower(name), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_sort(F.array_except(words, F.array(*[F.lit(x) for x in LEGAL])))


_WORDS = regex.compile(r"[\p{L}\p{N}]+")


def fold(name: str | None) -> list[str]:
    """As :func:`name_tokens`, after decomposing, dropping combining marks and folding case."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c)).casefold()
    return sorted({w for w in _WORDS.findall(plain) if w not in LEGAL})


@F.arrow_udf(ArrayType(StringType()))
def folded_tokens(names: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Tokens of :func:`fold`; of a batch, only ``SLICE`` texts and their words are Python objects at a time."""
    for batch in names:
        done = [pa.array([fold(name) for name in batch.slice(at, SLICE).to_pylist()], pa.list_(pa.string())) for at in range(0, len(batch), SLICE)]
        yield pa.concat_arrays(done) if done else pa.array([], pa.list_(pa.string()))


def name_key(name: Column) -> Column:
    """Lower case, words joined by one space, without ``city of`` or ``city`` around the name."""
    words = F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))
    return F.regexp_replace(words, r"^city of | city$", "")


def geohash(lat: Column, lon: Column, precision: int) -> Column:
    """Geohash by interleaving the bits of both coordinates' cells."""
    bits = 5 * precision
    east, north = (bits + 1) // 2, bits // 2

    def cell(x: Column, span: int, n: int) -> Column:
        at = F.floor((x + span) / (2 * span) * (1 << n)).cast("long")
        return F.greatest(F.lit(0), F.least(F.lit((1 << n) - 1), at))

    x, y = cell(lon, 180, east), cell(lat, 90, north)
    chars = []
    for c in range(precision):
        value = F.lit(0).cast("long")
        for b in range(5):
            k = 5 * c + b
            source, at = (x, east - 1 - k // 2) if k % 2 == 0 else (y, north - 1 - k // 2)
            value = value + F.shiftleft(F.shiftright(source, at).bitwiseAND(F.lit(1)), 4 - b)
        chars.append(F.substring(F.lit(BASE32), (value + 1).cast("int"), F.lit(1)))
    return F.concat(*chars)


def geohash_box(code: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of a cell."""
    bits = F.array_join(F.transform(F.filter(F.split(code, ""), lambda c: c != ""), lambda c: F.lpad(F.bin((F.instr(F.lit(BASE32), c) - 1).cast("long")), 5, "0")), "")
    n = F.length(code) * 5

    def pick(odd: int) -> Column:
        return F.array_join(F.filter(F.split(bits, ""), lambda _, i: (i % 2 == odd)), "")

    def low(text: Column, span: int) -> tuple[Column, Column]:
        width = F.lit(2.0 * span) / F.pow(F.lit(2.0), F.length(text))
        start = F.conv(text, 2, 10).cast("double") * width - span
        return start, start + width

    (x0, x1), (y0, y1) = low(pick(0), 180), low(pick(1), 90)
    return F.when(n > 0, F.struct(x0.alias("xmin"), y0.alias("ymin"), x1.alias("xmax"), y1.alias("ymax")))


def failure_class(reason: Column) -> Column:
    """The cause of a failed read from its text; the status code first, then words in the order of CAUSES."""
    text, code = F.lower(reason), F.regexp_extract(reason, r"HTTP (\d{3})", 1)
    out = F.lit("other")
    for words, cause in reversed(CAUSES):
        hit = F.lit(False)
        for w in words:
            hit = hit | F.contains(text, F.lit(w))
        out = F.when(hit, cause).otherwise(out)
    by_code = F.when(code.isin("401", "403", "404"), code).when(code.startswith("5"), "5xx").otherwise("other_http")
    return F.when(F.coalesce(reason, F.lit("")) == "", F.lit(None)).when(code != "", by_code).otherwise(out)


def redistribution(declared: Column, spdx: Column) -> Column:
    """True, false or unknown: what is declared, else true for a permissive licence."""
    said = F.lower(F.trim(declared))
    return F.when(said.isin("true", "yes"), True).when(said.isin("false", "no"), False).when(spdx.isin(PERMISSIVE), True)


def mode_of(route_type: Column) -> Column:
    """The mode of a route type, basic or extended."""
    t = route_type
    return (
        F.when(t.isin(0, 5) | t.between(900, 999), "tram").when((t == 1) | t.between(400, 404), "subway").when(t.isin(2, 12) | t.between(100, 199), "rail")
        .when(t.isin(3, 11) | t.between(200, 299) | t.between(700, 899), "bus").when((t == 4) | t.between(1000, 1099) | (t == 1200), "ferry").otherwise("other")
    )


def minted_id(prefix: str, raw: Column) -> Column:
    """An id of our own for a catalogue's: lower case, other characters than letters, digits, ``~`` and ``.`` as ``-``."""
    return F.concat(F.lit(f"f-{prefix}-"), F.regexp_replace(F.lower(raw), "[^a-z0-9~.]+", "-"))


def one_line(text: Column) -> Column:
    """Text on one line: control characters and runs of white space as one space."""
    return F.trim(F.regexp_replace(text, r"[\x00-\x20\x7F]+", " "))


def markdown_cell(text: Column) -> Column:
    return F.regexp_replace(one_line(text), r"([\\|`*_<>\[\]])", r"\\$1")


def csv_cell(text: Column) -> Column:
    """A cell that no spreadsheet takes for a formula."""
    return F.when(text.rlike(r"^[=+\-@\t\r]"), F.concat(F.lit("'"), text)).otherwise(text)


def listed(text: Column, mark: str) -> Column:
    """Parts of a list in one text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), mark), lambda x: F.trim(x)), lambda x: x != "")


def valid_id(raw: Column, most: int = 200) -> Column:
    """No control character or slash, not empty, a dot or two, at most ``most`` bytes."""
    return F.coalesce(~raw.rlike(r"[\x00-\x1F\x7F/\\]") & (raw != "") & ~raw.isin(".", "..") & (F.octet_length(raw) <= most), F.lit(False))


def day_of_text(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def line_name(short: Column, long: Column) -> Column:
    """The short name, else the long, without white space, in lower case."""
    return F.nullif(F.lower(F.regexp_replace(F.coalesce(F.nullif(F.trim(short), F.lit("")), long), r"\s+", "")), F.lit(""))


def snapshot_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\n", *parts), 256), 1, 16)
