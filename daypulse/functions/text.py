"""Token matching and highlighting with explicit ASCII word classes.

Word characters are ``[A-Za-z0-9_]``; case folding is done in the pattern
(``the`` -> ``[Tt][Hh][Ee]``), not with ``lower()``, so the result does not
depend on the regex engine's Unicode rules or on locale-sensitive lowering."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = "A-Za-z0-9_"
SEP = f"[^{WORD}]"


def token_class(token: str) -> str:
    out = []
    for ch in token:
        if ch.isascii() and ch.isalpha():
            out.append(f"[{ch.upper()}{ch.lower()}]")
        else:
            out.append(re.escape(ch))
    return "".join(out)


def token_pattern(token: str) -> str:
    """Regex matching ``token`` as a whole word, any ASCII case."""
    return f"(^|{SEP}){token_class(token)}({SEP}|$)"


def has_token(text: Column, token: str) -> Column:
    return text.rlike(token_pattern(token))


def token_hits(text: Column, token: str) -> Column:
    """Number of whole-word occurrences of ``token`` in the whole text."""
    t = token.lower()
    words = F.split(text, f"{SEP}+")
    return F.size(F.filter(words, lambda w: F.lower(w) == F.lit(t))).cast("bigint")


def highlight(text: Column, token: str, pre: str, post: str) -> Column:
    """Wrap every whole-word occurrence in ``pre``/``post`` (look-around keeps
    the separators, so adjacent occurrences are all marked)."""
    pat = f"(?<![{WORD}])({token_class(token)})(?![{WORD}])"
    return F.regexp_replace(text, pat, f"{pre}$1{post}")


def keyword_filter(text: Column, keyword: str | None) -> Column:
    """Empty keyword means every row."""
    if not keyword:
        return F.lit(True)
    return has_token(text, keyword)
