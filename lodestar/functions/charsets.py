"""Charset detection and the repair of texts that were decoded with the wrong one."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that two-byte UTF-8 shows as when it is read as Latin-1.
LEADS = "ÃÂâãïåæçéèêëìíîðñòóôõöùúûüýþÿ"
PAIR = re.compile(f"[{LEADS}][\u0080-ÿ]")
BLOCK = re.compile(f"(?:[{LEADS}][\u0080-ÿ]){{3,}}")
CONTROLS = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
PRIVATE = re.compile("[-]")
CJK = re.compile("[㐀-鿿]")
#: Names of charsets, and what they stand for.
ALIASES = {"utf8": "utf-8", "unicode-1-1-utf-8": "utf-8", "iso8859-1": "latin-1", "iso-8859-1": "latin-1", "latin1": "latin-1", "us-ascii": "ascii", "windows-1252": "cp1252", "gbk": "gb18030", "gb2312": "gb18030", "gb-2312": "gb18030", "gb-2312-80": "gb18030", "x-gbk": "gb18030", "cp936": "gb18030", "big-5": "big5", "big5-hkscs": "big5"}
WEAK = {"latin-1", "ascii", "cp1252"}


def _by_rows(first: int, last: int) -> set[str]:
    """Characters of GB 2312 rows: its first level is the set of common characters, by rule."""
    out = set()
    for row in range(first, last + 1):
        for cell in range(1, 95):
            try:
                out.add(bytes([0xA0 + row, 0xA0 + cell]).decode("gb2312"))
            except UnicodeDecodeError:
                pass
    return out


#: GB 2312 orders characters by use: rows 16-55 hold the common ones. A parameter of what judges by it:
#: a shorter list makes shares lower.
COMMON = frozenset(_by_rows(16, 55))
#: Characters that UTF-8 text shows as when it is read as GBK.
SUSPECT = "涓鍥鍙鍚鍦鍐鍒鍔鍛鍜鍝鍞鍟鍠鎴鎵鏂鏃鏄鏉鏋鏍鐪鐨鐢鐧閮闂闆闈娆灞宸岃祹楂垳笢佹"


def pairs(text: str) -> int:
    return len(PAIR.findall(text))


def common_share(text: str, common: frozenset[str] = COMMON) -> float:
    found = CJK.findall(text)
    return sum(c in common for c in found) / len(found) if found else 0.0


def suspect(text: str) -> int:
    return sum(c in SUSPECT for c in CJK.findall(text))


def quality(text: str, common: frozenset[str] = COMMON) -> float:
    """Higher for text that reads as meant."""
    if not text:
        return -1e9
    n = len(CJK.findall(text))
    share = common_share(text, common)
    score = 1.5 * n + 0.05 * len(re.findall("[A-Za-z0-9]", text)) - 6 * pairs(text) - 8 * text.count("�") - 3 * len(CONTROLS.findall(text)) - 12 * len(PRIVATE.findall(text)) - 0.8 * suspect(text)
    return score + 40 * share - 30 * (1 - share) if n >= 6 else score


def reads_as_gbk(text: str, common: frozenset[str] = COMMON) -> bool:
    """Whether UTF-8 was probably read as GBK."""
    n = len(CJK.findall(text))
    if n < 6:
        return False
    share = common_share(text, common)
    return (share <= 0.22 and suspect(text) >= max(3, n // 7)) or (bool(PRIVATE.search(text)) and share <= 0.35)


def redecoded(text: str | None, common: frozenset[str] = COMMON) -> str:
    """The best of the text and its re-decodings, if that is clearly better."""
    if not text:
        return ""
    tries = []
    for source, errors in (("latin-1", "strict"), ("latin-1", "ignore"), ("cp1252", "strict"), ("cp1252", "ignore")):
        try:
            tries.append(text.encode(source).decode("utf-8", errors))
        except UnicodeError:
            continue
    if reads_as_gbk(text, common):
        tries.append(text.encode("gb18030", "ignore").decode("utf-8", "ignore"))
    bad = lambda t: pairs(t) + t.count("�")
    worth = {t: quality(t, common) for t in [text, *tries]}
    best = max([text, *tries], key=worth.__getitem__)  # the first of equals
    clearly = bad(best) + 2 <= bad(text) or worth[best] >= worth[text] + 12
    return best if best != text and clearly else text


def ungarbled(text: str) -> str:
    """What stays garbled goes."""
    if pairs(text) >= 6:
        text = BLOCK.sub(" ", text)
    return CONTROLS.sub(" ", text.replace("�", " "))


def repaired_text(text: str | None, common: frozenset[str] = COMMON) -> str:
    return ungarbled(redecoded(text, common))


def charset_name(name: str | None) -> str | None:
    if not name:
        return None
    key = name.strip().strip("\"'").lower().replace("_", "-")
    return ALIASES.get(key, key)


def declared(raw: bytes, content_type: str | None) -> tuple[str | None, str | None]:
    """The charset of the header and the one of the page's first bytes."""
    header = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type or "", re.IGNORECASE)
    meta = re.search(rb"<meta[^>]+charset=[\"']?\s*([a-zA-Z0-9._:-]+)", raw[:4096], re.IGNORECASE)
    return charset_name(header[1]) if header else None, charset_name(meta[1].decode("ascii", "ignore")) if meta else None


def charsets_to_try(raw: bytes, content_type: str | None, response: str | None, apparent: str | None) -> list[str]:
    """UTF-8 and what is declared, then what the response says unless that is a mere default; Chinese
    ones and the apparent one where something speaks for them."""
    header, meta = declared(raw, content_type)
    told, seen = charset_name(response), charset_name(apparent)
    plain = raw.decode("utf-8", "replace")
    odd = plain.count("�") + pairs(plain) >= 8 or any(c.startswith(("gb", "big5")) for c in (header, meta, told, seen) if c)
    order = ["utf-8", header, meta, None if told in WEAK else told, "latin-1"]
    if odd or not (header or meta):
        order.append(seen)
    if odd:
        order += ["gb18030", "big5"]
    return list(dict.fromkeys(c for c in order if c))


def decoded(raw: bytes | None, content_type: str | None = None, response: str | None = None, apparent: str | None = None, common: frozenset[str] = COMMON) -> tuple[str, str]:
    """A page's text, repaired, and the charset it was read with: the first of best quality."""
    if not raw:
        return "", ""
    best: tuple[float, str, str] | None = None
    for name in charsets_to_try(raw, content_type, response, apparent):
        try:
            text = redecoded(raw.decode(name, "replace"), common)
        except LookupError:
            continue
        if best is None or quality(text, common) > best[0]:
            best = (quality(text, common), text, name)
    text, name = ungarbled(best[1]), best[2]
    return (text, name) if text else (raw.decode("utf-8", "replace"), "utf-8")


@F.pandas_udf(T.StringType())
def repaired(c: pd.Series) -> pd.Series:
    return c.map(repaired_text)


@F.pandas_udf(T.StringType())
def page_text(raw: pd.Series, content_type: pd.Series) -> pd.Series:
    return pd.Series([decoded(r, t)[0] for r, t in zip(raw, content_type, strict=True)])
