"""DuckDB SQL fragments that mirror the Spark expressions exactly (oracle side).

DuckDB's RE2 ``[[:punct:]\\s]`` is Java's ``[\\p{Punct}\\s]`` on this data (Java also
counts vertical tab as whitespace). Hash positions come from
``functions.hashing.sql_hash_positions`` (same md5 bits).
"""

from __future__ import annotations

from wordlens.functions.hashing import sql_hash_bucket, sql_hash_positions  # noqa: F401
from wordlens.operators.bloom import sql_blocks, sql_place
from wordlens.operators.cms import PREFIX_BITS, PREFIX_ROWS, sql_prefix_place
from wordlens.params import SHIPPED_STOP_WORDS

DELIM = r"[[:punct:]\s]+"


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stop_list(stop_words=SHIPPED_STOP_WORDS) -> str:
    return "[" + ", ".join(quote(w) for w in sorted({w.lower() for w in stop_words})) + "]"


def clean_words(text: str, stop_words=SHIPPED_STOP_WORDS, drop_empty: bool = True) -> str:
    stops = stop_list(stop_words)
    if drop_empty:
        return (f"list_filter(string_split_regex(lower({text}), '{DELIM}'), "
                f"lambda x: x <> '' AND NOT list_contains({stops}, x))")
    kept = (f"list_filter(string_split_regex(regexp_replace(lower({text}), '{DELIM}$', ''), "
            f"'{DELIM}'), lambda x: NOT list_contains({stops}, x))")
    return f"(CASE WHEN len({kept}) = 0 THEN [''] ELSE {kept} END)"


def tokens(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '{DELIM}'), lambda x: x <> '')"


#: Fixed values for the oracle's own reading of HTML: block-level tags, and references that the pages use.
_BLOCKS = ("p address article aside blockquote details dd dir div dl dt fieldset figcaption figure footer form "
           "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol pre section table ul").split()
_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "#39": "\x27", "nbsp": " ", "amp": "&"}


def page_description(html: str) -> str:
    """Text of the first paragraph inside the first article, null if there is none. The page is cut at every "<"
    into pieces (a tag and the text after it), and the wanted pieces are found by their tags' names."""
    plain = f"regexp_replace({html}, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g')"
    name = "lower(regexp_extract(x, '^/?[A-Za-z][A-Za-z0-9]*'))"
    pieces = f"list_transform(string_split({plain}, '<')[2:], lambda x: {{'tag': {name}, 'text': x[strpos(x, '>') + 1:]}})"
    after = f"list_transform([{pieces}], lambda l: l[list_position(list_transform(l, lambda x: x.tag), 'article') + 1:])[1]"
    # the end tag after which as many articles were closed as opened, counted from the start for every piece
    closed = ("list_position(list_transform(range(1, len(l) + 1), lambda i: list_sum(list_transform(l[:i], "
              "lambda x: CASE x.tag WHEN 'article' THEN 1 WHEN '/article' THEN -1 ELSE 0 END)) = -1), true)")
    inside = f"list_transform([{after}], lambda l: CASE WHEN {closed} > 0 THEN l[:{closed} - 1] ELSE l END)[1]"
    rest = (f"list_transform([{inside}], lambda l: CASE WHEN list_contains(list_transform(l, lambda x: x.tag), 'p') "
            "THEN l[list_position(list_transform(l, lambda x: x.tag), 'p'):] END)[1]")
    blocks = ", ".join(f"'{t}', '/{t}'" for t in _BLOCKS)
    ends = f"list_position(list_transform(l[2:], lambda x: x.tag IN ({blocks})), true)"
    own = f"list_transform([{rest}], lambda l: CASE WHEN {ends} IS NULL OR {ends} = 0 THEN l ELSE l[:{ends}] END)[1]"
    text = (f"list_transform([{own}], lambda l: array_to_string(list_transform(l, "
            "lambda x: CASE WHEN x.tag = 'br' THEN ' ' ELSE '' END || x.text), ''))[1]")
    for entity, char in _REFERENCES.items():
        text = f"replace({text}, '&{entity};', {quote(char)})"
    found = f"list_contains(list_transform({pieces}, lambda x: x.tag), 'article') AND {rest} IS NOT NULL"
    return f"CASE WHEN {found} THEN trim(regexp_replace({text}, '\\s+', ' ', 'g')) END"


def url_short_name(url: str) -> str:
    return f"string_split(regexp_replace({url}, '/+$', ''), '/')[-1]"


def word_rows(table: str, text: str = "text", **kw) -> str:
    """SELECT producing one ``word`` row per kept occurrence."""
    return f"SELECT unnest({clean_words(text, **kw)}) AS word FROM {table}"


def sketch_cells(words_sql: str, depth: int, width: int, seed: int) -> str:
    pos = sql_hash_positions("w.word", seed, "t.i", width)
    return (f"SELECT CAST(t.i AS INTEGER) AS row, CAST({pos} AS BIGINT) AS bucket, "
            f"CAST(count(*) AS BIGINT) AS cnt FROM ({words_sql}) w CROSS JOIN range({depth}) t(i) "
            f"GROUP BY ALL")


def _prefix(word: str, seed: int, bits: int) -> str:
    return f"(CAST(('0x' || substr(md5('{seed}:' || {word}), 1, 8)) AS BIGINT) >> {32 - bits})"


def _levels(word: str, width: int, seed: int) -> list[tuple[int, int, str]]:
    """(level, row, bucket) of a word's cells above the words' own."""
    out = [(1, 0, _prefix(word, seed, PREFIX_BITS[0]))]
    for level, bits in enumerate(PREFIX_BITS[1:], 2):
        out += [(level, r, sql_prefix_place(_prefix(word, seed, bits), r, width)) for r in range(PREFIX_ROWS)]
    return out


def hierarchy_cells(words_sql: str, depth: int, width: int, seed: int) -> str:
    own = f"SELECT 0 AS level, row, bucket, cnt FROM ({sketch_cells(words_sql, depth, width, seed)})"
    above = [f"SELECT {level} AS level, {row} AS row, CAST({bucket} AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS cnt "
             f"FROM ({words_sql}) w GROUP BY ALL" for level, row, bucket in _levels("w.word", width, seed)]
    return " UNION ALL ".join([own, *above])


def found_in_hierarchy(hitters_sql: str, levels_sql: str, width: int, seed: int, share: float) -> str:
    """Heavy hitters (word, est) all whose cells in the levels hold at least ``share`` of all items."""
    places = ", ".join(f"({level}, {row}, {bucket})" for level, row, bucket in _levels("h.word", width, seed))
    return (f"WITH cells AS ({levels_sql}), total AS (SELECT sum(cnt) AS n FROM cells WHERE level = 0 AND row = 0) "
            f"SELECT h.word, h.est FROM ({hitters_sql}) h, total WHERE (SELECT min(coalesce(c.cnt, 0)) "
            f"FROM (VALUES {places}) p(level, row, bucket) LEFT JOIN cells c USING (level, row, bucket)) >= {share!r} * total.n")


def estimates(vocab_sql: str, cells_sql: str, depth: int, width: int, seed: int) -> str:
    pos = sql_hash_positions("v.word", seed, "t.i", width)
    return (f"SELECT v.word, CAST(min(coalesce(c.cnt, 0)) AS BIGINT) AS est "
            f"FROM ({vocab_sql}) v CROSS JOIN range({depth}) t(i) "
            f"LEFT JOIN ({cells_sql}) c ON c.row = t.i AND c.bucket = {pos} GROUP BY v.word")


def bloom_bits(urls_sql: str, k: int, seed: str) -> str:
    """The filter of the URLs, in the shape for their number."""
    block, mask = sql_place("u.url", sql_blocks("n.n"), k, seed)
    return (f"WITH u AS ({urls_sql}), n AS (SELECT count(*) AS n FROM u) "
            f"SELECT {block} AS block, bit_or({mask}) AS bits FROM u, n GROUP BY 1")
