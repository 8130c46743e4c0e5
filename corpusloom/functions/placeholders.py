"""Inline image placeholders: opaque tokens that carry an image's address and text through a translation."""

from __future__ import annotations

import re
import sys
from urllib.parse import quote, unquote_to_bytes

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SAFE_ALT, SAFE_SRC, percent_decode, percent_encode

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OPEN, CLOSE = "⟦EPUB_IMG:", "⟧"
TOKEN = rf"{OPEN}[^|⟧]*\|alt=[^⟧]*{CLOSE}"
PARTS = rf"^{OPEN}([^|⟧]*)\|alt=([^⟧]*){CLOSE}\z"


def encode(src: Column, alt: Column) -> Column:
    return F.concat(F.lit(OPEN), percent_encode(src, SAFE_SRC), F.lit("|alt="), percent_encode(alt, SAFE_ALT), F.lit(CLOSE))


def extract(s: Column) -> Column:
    """All tokens in order; a dangling prefix is no token."""
    return F.regexp_extract_all(s, F.lit(f"({TOKEN})"), F.lit(1))


def parse(token: Column) -> Column:
    """struct<src, alt>, or null unless the token is exactly what encode gives for them."""
    src, alt = percent_decode(F.regexp_extract(token, PARTS, 1)), percent_decode(F.regexp_extract(token, PARTS, 2))
    return F.when(token.rlike(PARTS) & (encode(src, alt) == token), F.struct(src.alias("src"), alt.alias("alt")))


def is_malformed(s: Column) -> Column:
    """A token's prefix that no token follows, or a token that is not canonical."""
    dangling = F.regexp_replace(s, TOKEN, "").contains(OPEN)
    return dangling | F.exists(extract(s), lambda t: parse(t).isNull())


def display(s: Column) -> Column:
    """Tokens give way to their images' texts."""
    texts = F.transform(extract(s), lambda t: F.try_url_decode(F.replace(F.regexp_extract(t, PARTS, 2), F.lit("+"), F.lit("%2B"))))
    gaps = F.split(s, TOKEN, -1)
    return F.array_join(F.flatten(F.zip_with(gaps, texts, lambda g, t: F.array(F.coalesce(g, F.lit("")), F.coalesce(t, F.lit(""))))), "")


def encode_py(src: str, alt: str) -> str:
    return f"{OPEN}{quote(src, safe=SAFE_SRC)}|alt={quote(alt, safe=SAFE_ALT)}{CLOSE}"


def parse_py(token: str) -> tuple[str, str]:
    found = re.fullmatch(PARTS.replace(r"\z", "$"), token)
    if not found:
        raise ValueError(f"malformed image placeholder: {token}")
    try:
        src, alt = (unquote_to_bytes(x).decode("utf-8") for x in found.groups())
    except UnicodeDecodeError:
        raise ValueError(f"image placeholder is not UTF-8: {token}") from None
    if encode_py(src, alt) != token:
        raise ValueError(f"non-canonical image placeholder: {token}")
    return src, alt


def tokenize_py(s: str) -> list[tuple[str, str, str | None, str | None]]:
    """(kind, text, src, alt) of texts and images in order; malformed tokens are an error."""
    out, at = [], 0
    for m in re.finditer(TOKEN, s):
        if m.start() > at:
            out.append(("text", s[at : m.start()], None, None))
        out.append(("image", m[0], *parse_py(m[0])))
        at = m.end()
    if at < len(s):
        out.append(("text", s[at:], None, None))
    if any(OPEN in text for kind, text, *_ in out if kind == "text"):
        raise ValueError("malformed image placeholder")
    return out


def _tokenize_series(s: pd.Series) -> pd.DataFrame:
    errors, tokens = [], []
    for x in s:
        try:
            rows = [dict(zip(("kind", "text", "src", "alt"), t)) for t in tokenize_py(x)] if x is not None else None
            errors.append(None)
            tokens.append(rows)
        except ValueError as e:
            errors.append(str(e))
            tokens.append(None)
    return pd.DataFrame({"error": errors, "tokens": tokens})


def tokenize(s: Column) -> Column:
    """struct<error, tokens>: texts and images in order, or an error. The interleaving has no built-in form that also reports the first bad token."""
    kind = "struct<error: string, tokens: array<struct<kind: string, text: string, src: string, alt: string>>>"
    return F.pandas_udf(_tokenize_series, kind)(s)
