"""Plain-Python brute-force versions of the text rules, for checking Spark results.

Java semantics: ``\\p{Punct}`` is ASCII punctuation, ``\\s`` is [ \\t\\n\\x0B\\f\\r];
``String.split`` keeps a leading empty token and drops trailing empty tokens.
"""

from __future__ import annotations

import re
import string

from wordlens.params import SHIPPED_STOP_WORDS

DELIM = re.compile("[" + re.escape(string.punctuation) + " \t\n\x0b\f\r]+")


def java_split(text: str) -> list[str]:
    parts = DELIM.split(text.lower())
    if len(parts) == 1:  # no delimiter matched: the input itself
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def clean(text: str, stop_words=SHIPPED_STOP_WORDS, drop_empty: bool = True) -> list[str]:
    stops = {w.lower() for w in stop_words}
    if drop_empty:
        return [w for w in DELIM.split(text.lower()) if w and w not in stops]
    kept = [w for w in java_split(text) if w not in stops]
    # the original re-joins with spaces and splits again on " "
    return " ".join(kept).split(" ")


def short_name(url: str) -> str:
    return re.sub("/+$", "", url).split("/")[-1]
