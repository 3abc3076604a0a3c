"""Text helpers: whitespace, UTF-8, identifiers, links, ordered text fold."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardgrid import constants as C

# ASCII whitespace removed around values (plain trim() removes blanks only).
_WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(col: Column) -> Column:
    """Remove leading and trailing whitespace, line breaks included."""
    return F.btrim(col, F.lit(_WHITESPACE))


def text_or_null(col: Column) -> Column:
    """Trimmed text, with empty text as null."""
    return F.nullif(strip_ws(col), F.lit(""))


def lower_or_empty(col: Column) -> Column:
    return F.lower(F.coalesce(col, F.lit("")))


def upper_or_empty(col: Column) -> Column:
    return F.upper(F.coalesce(col, F.lit("")))


def utf8_text(binary: Column) -> Column:
    """Bytes as text, null unless they are valid UTF-8."""
    text = binary.cast("string")
    # Read as Latin-1 only ASCII keeps its length in UTF-8; other bytes are checked one by one.
    ascii_only = F.octet_length(F.decode(binary, "ISO-8859-1")) == F.octet_length(binary)
    return F.when(ascii_only | F.is_valid_utf8(text), text)


# Encodings an XML declaration may name, by the names Spark decodes them under.
_ENCODINGS = {
    "utf-8": "UTF-8",
    "utf8": "UTF-8",
    "us-ascii": "US-ASCII",
    "ascii": "US-ASCII",
    "iso-8859-1": "ISO-8859-1",
    "latin-1": "ISO-8859-1",
    "utf-16": "UTF-16",
    "utf-16be": "UTF-16BE",
    "utf-16le": "UTF-16LE",
}
_DECLARED = r"""^(?:\xEF\xBB\xBF)?<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)["']"""


def xml_text(binary: Column) -> Column:
    """Bytes of an XML document as text, in the encoding it declares.

    Without a declaration a byte order mark or UTF-8 counts. Bytes that are not
    valid in that encoding, or an encoding that is not known, give null.
    """
    head = F.decode(F.substring(binary, 1, 200), "ISO-8859-1")
    marked = F.when(F.hex(F.substring(binary, 1, 2)).isin("FEFF", "FFFE"), "utf-16")
    name = F.coalesce(marked, F.nullif(F.lower(F.regexp_extract(head, _DECLARED, 1)), F.lit("")), F.lit("utf-8"))
    text = F.when(name.isin("utf-8", "utf8"), utf8_text(binary))
    for written, charset in _ENCODINGS.items():
        if charset != "UTF-8":
            text = text.when(name == written, F.decode(binary, charset))
    # The text is no longer in that encoding, so it must not declare it.
    return F.regexp_replace(text, r"^\uFEFF?<\?xml[^>]*\?>", "")


# Prolog (comments and instructions) in front of the root element, and what may follow it.
_PROLOG = r"(?s)^\uFEFF?\s*+(?:(?:<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*+>)\s*+)*+"
_EPILOG = r"\s*+(?:(?:<\?.*?\?>|<!--.*?-->)\s*+)*+$"


def root_tag(xml: Column) -> Column:
    """Name and attributes of the root element, as written in its start tag."""
    return F.regexp_extract(xml, _PROLOG + r"<([^\s/>!?][^>]*+)>", 1)


def closes_root(xml: Column, tag: Column) -> Column:
    """Whether the document ends with the end tag of its root element (or is that one empty tag)."""
    name = F.regexp_extract(tag, r"^([^\s/]+)", 1)
    # Mostly nothing stands behind the last end tag; only otherwise is the text searched.
    last = F.regexp_extract(F.substring_index(xml, "</", -1), r"^([^\s>]+)\s*>\s*$", 1)
    tail = F.when(last != "", last).otherwise(F.regexp_extract(xml, r"(?s)</([^\s>]+)\s*>" + _EPILOG, 1))
    return (name != "") & ((tail == name) | tag.endswith("/"))


def namespace_of(tag: Column) -> Column:
    """Namespace that a start tag binds to its own prefix; empty if it binds none."""
    prefix = F.regexp_extract(tag, r"^([^\s:/]+):", 1)
    attribute = F.when(prefix == "", "xmlns").otherwise(F.concat(F.lit("xmlns:"), prefix))
    pairs = F.regexp_extract_all(tag, F.lit(r"""\s([^\s=]+)\s*=\s*("[^"]*"|'[^']*')"""), F.lit(0))
    own = F.filter(pairs, lambda p: F.regexp_extract(p, r"^\s([^\s=]+)", 1) == attribute)
    return F.coalesce(F.regexp_extract(F.get(own, F.lit(0)), r"""=\s*["'](.*)["']$""", 1), F.lit(""))


def utf8_lossy(binary: Column) -> Column:
    """Bytes as text with undecodable bytes replaced, for audit copies."""
    return F.make_valid_utf8(binary.cast("string"))


def alert_identifier(url: Column) -> Column:
    """Last path segment of a link without the alert-file suffix."""
    # A link of ASCII characters without line breaks needs no search for its end.
    plain = (F.octet_length(url) == F.length(url)) & ~F.contains(url, F.lit("\n")) & ~F.contains(url, F.lit("\r"))
    last = F.substring_index(F.rtrim(url, F.lit("/")), "/", -1)
    named = F.when(last.endswith(C.CAP_FILE_SUFFIX), F.left(last, F.length(last) - len(C.CAP_FILE_SUFFIX))).otherwise(last)
    trimmed = F.regexp_replace(url, "/+$", "")
    return F.when(plain, named).otherwise(F.regexp_extract(trimmed, r"([^/]*?)(?:_alert\.xml)?$", 1))


def resolve_link(base_url: str, link: Column) -> Column:
    """Resolve ``link`` against a constant base URL (RFC 3986, section 5.2)."""
    base = urlsplit(base_url)
    origin = f"{base.scheme}://{base.netloc}"
    folder = base.path.rsplit("/", 1)[0] + "/"
    base_query = f"?{base.query}" if base.query else ""

    # Mostly a link is nothing but a path.
    only_path = ~link.contains("?") & ~link.contains("#")
    path = F.when(only_path, link).otherwise(F.regexp_extract(link, r"^([^?#]*)", 1))
    tail = F.when(only_path, F.lit("")).otherwise(F.regexp_extract(link, r"^[^?#]*(.*)$", 1))
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(folder), path))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link.startswith("//"), F.concat(F.lit(base.scheme + ":"), link))
        .when(link == "", F.lit(f"{origin}{base.path}{base_query}"))
        .when(link.startswith("#"), F.concat(F.lit(f"{origin}{base.path}{base_query}"), link))
        .when(link.startswith("?"), F.concat(F.lit(f"{origin}{base.path}"), link))
        .otherwise(F.concat(F.lit(origin), _without_dot_segments(rooted), tail))
    )


def _without_dot_segments(path: Column) -> Column:
    """Collapse ``.`` and ``..`` in an absolute path; one without empty or dotted segments stays."""
    segments = F.filter(F.split(path, "/"), lambda s: ~s.isin("", "."))
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(
            s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(s))),
    )
    folder = path.rlike(r"(/|/\.|/\.\.)$") & (F.size(kept) > 0)
    collapsed = F.concat(
        F.lit("/"),
        F.array_join(kept, "/"),
        F.when(folder, F.lit("/")).otherwise(F.lit("")),
    )
    return F.when(~path.contains("//") & ~path.contains("/."), path).otherwise(collapsed)


def fold_texts(ordered: Column, separator: str = "; ") -> Column:
    """Join an ordered array of texts, skipping any that the text so far contains.

    Null and empty texts are skipped; an array without text folds to null.
    """
    folded = F.aggregate(
        F.filter(ordered, lambda t: F.coalesce(t, F.lit("")) != ""),
        F.lit(""),
        lambda acc, t: F.when(acc == "", t)
        .when(F.contains(acc, t), acc)
        .otherwise(F.concat(acc, F.lit(separator), t)),
    )
    return F.nullif(folded, F.lit(""))
