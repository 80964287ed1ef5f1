"""Text expressions: Column -> Column, all built-in Spark SQL functions (JVM, codegen).

Tokenizer semantics: lower-case, then split on runs of ASCII punctuation or whitespace
(Java ``[\\p{Punct}\\s]+``). Accented letters, curly quotes and dashes outside ASCII are
word characters. A text that starts with a delimiter yields a leading empty token,
trailing delimiters yield nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wordlens.params import SHIPPED_STOP_WORDS

# Fixed value: the token delimiter (Java regex syntax, as used by Spark's split).
DELIMITER = r"[\p{Punct}\s]+"
_TRAILING_DELIMITERS = DELIMITER + "$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_tokens(text: Column | str) -> Column:
    """Java ``String.split`` of the lower-cased text: leading "" kept, trailing dropped.

    Spark's ``split`` keeps trailing empty strings, so trailing delimiters are removed
    first; an all-delimiter text becomes ``[""]``.
    """
    lowered = F.lower(_col(text))
    return F.split(F.regexp_replace(lowered, _TRAILING_DELIMITERS, ""), DELIMITER)


def tokenize(text: Column | str) -> Column:
    """Lower-cased words of ``text`` with empty tokens removed (array<string>)."""
    return F.filter(F.split(F.lower(_col(text)), DELIMITER), lambda w: w != F.lit(""))


def stop_word_array(stop_words: Iterable[str] = SHIPPED_STOP_WORDS) -> Column:
    """The stop list as a literal array, lower-cased like the text."""
    words = sorted({w.lower() for w in stop_words})
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def remove_stop_words(words: Column | str,
                      stop_words: Iterable[str] = SHIPPED_STOP_WORDS) -> Column:
    """Drop every occurrence of a stop word, keeping order and duplicates.

    (``array_except`` would also de-duplicate the remaining words, which is wrong here.)
    The list is a short literal; for a long one see ``counts.without_stop_table``.
    """
    stops = stop_word_array(stop_words)
    return F.filter(_col(words), lambda w: ~F.array_contains(stops, w))


def clean_words(text: Column | str,
                stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                drop_empty: bool = True) -> Column:
    """Tokenized, stop-word-filtered words of ``text``.

    ``drop_empty=False`` reproduces the original counting exactly: the leading empty
    token is kept, and a text with no surviving word contributes one empty word (its
    cleaned text "" splits into ``[""]``).
    """
    if drop_empty:
        return remove_stop_words(tokenize(text), stop_words)
    kept = remove_stop_words(split_tokens(text), stop_words)
    return _let(kept, lambda words: F.when(F.size(words) == 0, F.array(F.lit(""))).otherwise(words))


def explode_clean_words(df, text: Column | str,
                        stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                        drop_empty: bool = True, alias: str = "word"):
    """One row per kept word occurrence of ``text``: ``df.select(word)``.

    With ``drop_empty`` the raw split is exploded first and filtered by a plain
    predicate (``word != '' AND word NOT IN stops``, a hash-set test): this stays in
    whole-stage codegen, where the array ``filter`` lambdas of ``clean_words`` are
    interpreted per element. Same words, same order within a text.
    """
    if not drop_empty:
        return df.select(F.explode(clean_words(text, stop_words, drop_empty)).alias(alias))
    stops = sorted({w.lower() for w in stop_words})
    words = df.select(F.explode(F.split(F.lower(_col(text)), DELIMITER)).alias(alias))
    keep = F.col(alias) != F.lit("")
    if stops:
        keep = keep & ~F.col(alias).isin(*stops)
    return words.where(keep)


def cleaned_text(text: Column | str,
                 stop_words: Iterable[str] = SHIPPED_STOP_WORDS,
                 drop_empty: bool = True) -> Column:
    """The cleaned words joined by single spaces."""
    return F.array_join(clean_words(text, stop_words, drop_empty), " ")


def url_short_name(url: Column | str) -> Column:
    """Last path segment of a URL; trailing slashes are ignored."""
    trimmed = F.regexp_replace(_col(url), "/+$", "")
    return F.element_at(F.split(trimmed, "/"), -1)


def comma_list(value: str) -> list[str]:
    """A comma-separated parameter (stop words, topics) as a list."""
    return [v.strip() for v in value.split(",") if v.strip()]


# Fixed values of HTML. Blocks whose content is never visible text:
INVISIBLE_BLOCKS = r"(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>"
# Tags that end an open paragraph, whether they open or close:
BLOCK_TAGS = ("p", "address", "article", "aside", "blockquote", "details", "dd", "dir", "div", "dl", "dt",
              "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
              "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "pre", "section", "table", "ul")
# Named character references (case matters) and what they stand for:
NAMED_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "iexcl": "¡", "cent": "¢",
    "pound": "£", "yen": "¥", "sect": "§", "copy": "©", "laquo": "«", "raquo": "»", "reg": "®", "deg": "°",
    "plusmn": "±", "middot": "·", "frac12": "½", "iquest": "¿", "times": "×", "divide": "÷", "szlig": "ß",
    "Agrave": "À", "Aacute": "Á", "Acirc": "Â", "Atilde": "Ã", "Auml": "Ä", "Aring": "Å", "AElig": "Æ",
    "Ccedil": "Ç", "Egrave": "È", "Eacute": "É", "Ecirc": "Ê", "Euml": "Ë", "Igrave": "Ì", "Iacute": "Í",
    "Icirc": "Î", "Iuml": "Ï", "Ntilde": "Ñ", "Ograve": "Ò", "Oacute": "Ó", "Ocirc": "Ô", "Otilde": "Õ",
    "Ouml": "Ö", "Oslash": "Ø", "Ugrave": "Ù", "Uacute": "Ú", "Ucirc": "Û", "Uuml": "Ü", "agrave": "à",
    "aacute": "á", "acirc": "â", "atilde": "ã", "auml": "ä", "aring": "å", "aelig": "æ", "ccedil": "ç",
    "egrave": "è", "eacute": "é", "ecirc": "ê", "euml": "ë", "igrave": "ì", "iacute": "í", "icirc": "î",
    "iuml": "ï", "ntilde": "ñ", "ograve": "ò", "oacute": "ó", "ocirc": "ô", "otilde": "õ", "ouml": "ö",
    "oslash": "ø", "ugrave": "ù", "uacute": "ú", "ucirc": "û", "uuml": "ü", "yuml": "ÿ", "oelig": "œ",
    "OElig": "Œ", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”",
    "bull": "•", "hellip": "…", "euro": "€", "trade": "™",
}
# Elements that have no inside:
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
# The description's container: the first <article>, as a pattern of its start tag. For an element by its id, see element_by_id.
DEFAULT_CONTAINER = r"(?is)<article(?=[\s>/])[^>]*>"


def element_by_id(element_id: str) -> str:
    """A container pattern for the first element with this id."""
    return (r"""(?is)<[a-z][a-z0-9-]*\s(?:[^>]*\s)?id\s*=\s*["']?""" + re.escape(element_id)
            + r"""(?=["'\s>/])[^>]*>""")


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _decoded(text: Column) -> Column:
    """Character references decoded in one pass, from each & to the end of its reference."""
    names = F.create_map(*[F.lit(x) for pair in NAMED_ENTITIES.items() for x in pair])
    pattern = r"^(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]*);"

    def piece(x: Column, i: Column) -> Column:
        name = F.regexp_extract(x, pattern, 1)
        digits = F.regexp_replace(name, "^#[xX]?", "")
        code = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.lpad(digits, 8, "0")).otherwise(
            F.lpad(F.hex(F.try_to_number(digits, F.lit("9999999")).cast("bigint")), 8, "0"))
        known = F.conv(code, 16, 10).cast("bigint")
        numeric = F.when((known > 0) & (known <= 0x10FFFF) & ~known.between(0xD800, 0xDFFF),
                         F.decode(F.unhex(code), "UTF-32"))
        char = F.when(name.startswith("#"), numeric).otherwise(F.try_element_at(names, name))
        rest = F.regexp_replace(x, pattern, "")
        return F.when(i == 0, x).when(char.isNull(), F.concat(F.lit("&"), x)).otherwise(F.concat(char, rest))

    return F.when(~F.contains(text, F.lit("&")), text).otherwise(
        F.array_join(F.transform(F.split(text, "&"), piece), ""))


def _inside(name: Column, rest: Column) -> Column:
    """``rest`` up to the end tag that closes an element ``name`` whose start tag stands just before it: the depth is folded over the
    start and end tags of that name. An element that is never closed goes on to the end."""
    pieces = F.split(rest, F.concat(F.lit("(?i)<(?=/?"), name, F.lit(r"[\s>/])")))

    def scan(parts: Column) -> Column:
        def step(so_far: Column, tag: Column) -> Column:
            depth = so_far["depth"] + F.when(tag.startswith("/"), -1).otherwise(1)
            return F.when(so_far["depth"] == 0, so_far).otherwise(F.struct(
                depth.alias("depth"), (so_far["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n")))

        start = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("n"))
        n = F.aggregate(F.slice(parts, 2, F.size(parts)), start, step, lambda x: x["n"])
        return F.array_join(F.slice(parts, F.lit(1), n), "<")

    return F.when(F.lower(name).isin(*VOID_TAGS), F.lit("")).otherwise(_let(pieces, scan))


def description_html(html: Column | str, container: str = DEFAULT_CONTAINER) -> Column:
    """Inner HTML of the first paragraph within the container's own span; null if there is none.

    The container may hold elements of its own name, at any depth. A paragraph ends at any block-level tag, as a parser
    would close it there.
    """
    visible = F.regexp_replace(_col(html), INVISIBLE_BLOCKS, " ")
    # the start tag and all after it, told apart at the tag's end
    inside = _let(F.regexp_extract(visible, container + ".*$", 0), lambda x: _inside(
        F.regexp_extract(x, "^<([A-Za-z][A-Za-z0-9-]*)", 1), F.regexp_replace(x, "^[^>]*>", "")))
    stop = r"</?(?:" + "|".join(BLOCK_TAGS) + r")(?=[\s>/])"
    # group 1 is never empty, as it starts with the tag's own ">": "" means that no paragraph was found
    found = F.regexp_extract(inside, r"(?is)<p(?=[\s>])[^>]*(>.*?)(?:" + stop + "|$)", 1)
    return _let(found, lambda x: F.when(x != "", F.substr(x, F.lit(2))))


def page_description(html: Column | str, container: str = DEFAULT_CONTAINER) -> Column:
    """Visible text of the first paragraph in the container ("" if that is empty), null for a page without one.

    <br> separates words, inline tags do not; character references are decoded and runs of white space are one space.
    """
    inner = description_html(html, container)
    text = F.regexp_replace(F.regexp_replace(inner, r"(?i)<br\s*/?>", " "), r"<[a-zA-Z/!][^>]*>", "")
    return F.trim(F.regexp_replace(_let(text, _decoded), r"\s+", " "))


def described_pages(pages, url: str = "url", html: str = "html", **container):
    """(url, description) of the pages that have a description, extracting each page once.

    The description comes from a generator (an exploded array, empty where there is none) rather than
    an ``IS NOT NULL`` filter, which would be pushed below the projection with the whole regex
    chain inlined, so that every page would be parsed twice.
    """
    text = page_description(F.col(html), **container)
    return pages.select(F.col(url).alias("url"), F.explode(F.array_compact(F.array(text))).alias("description"))
