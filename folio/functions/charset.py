"""The character encoding of a text file, from marks and byte statistics of its beginning."""

from __future__ import annotations

import codecs
import re

HEAD = 50_000

# Byte-order marks, longest first, and the codecs that take them off
_MARKS = [(codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
# the letters that make up most of a Russian text
_RUSSIAN = set("оеаинтсрвлкмдпу")
# lead and trail bytes of the double-byte characters of everyday text: level 1 of each standard
_EVERYDAY = {
    "gb18030": re.compile(rb"[\xb0-\xd7][\xa1-\xfe]|\xa1[\xa1-\xfe]|\xa3[\xa1-\xfe]"),
    "big5": re.compile(rb"[\xa4-\xc6][\x40-\x7e\xa1-\xfe]|\xa1[\x40-\x7e\xa1-\xfe]"),
    "euc_jp": re.compile(rb"[\xa4\xa5][\xa1-\xf6]|[\xb0-\xcf][\xa1-\xfe]|\xa1[\xa1-\xfe]"),
    "shift_jis": re.compile(rb"[\x82\x83][\x40-\x7e\x80-\xfc]|[\x88-\x97][\x40-\x7e\x80-\xfc]|\x81[\x40-\x7e\x80-\xfc]"),
    "euc_kr": re.compile(rb"[\xb0-\xc8][\xa1-\xfe]|\xa1[\xa1-\xfe]"),
}


def _decodes(head: bytes, charset: str, whole: bool) -> str | None:
    """The text, if the bytes are valid; a character that the head's end cuts is allowed."""
    try:
        return codecs.getincrementaldecoder(charset)("strict").decode(head, final=whole)
    except UnicodeDecodeError:
        return None


def _wide(head: bytes) -> str | None:
    """UTF-16 or UTF-32 without a mark, by where the zero bytes of common characters are."""
    n = len(head) // 4 * 4
    if n < 4 or not head.count(0):
        return None
    zero = [head[i:n:4].count(0) * 4 / n for i in range(4)]
    if min(zero[2:]) > 0.9 and zero[0] < 0.5:
        return "utf-32-le"
    if min(zero[:2]) > 0.9 and zero[3] < 0.5:
        return "utf-32-be"
    low, high = (zero[0] + zero[2]) / 2, (zero[1] + zero[3]) / 2
    if high > low + 0.1:
        return "utf-16-le"
    return "utf-16-be" if low > high + 0.1 else None


def _double_byte(head: bytes, whole: bool) -> tuple[float, str] | None:
    """The best of the CJK encodings that the bytes are valid in: the share of their high bytes that
    everyday characters take, and what the text itself shows (kana, hangul)."""
    high = sum(b > 0x7F for b in head)
    best = None
    for charset, everyday in _EVERYDAY.items():
        text = _decodes(head, charset, whole)
        if text is None:
            continue
        taken = sum(sum(b > 0x7F for b in m) for m in everyday.findall(head)) / high
        wide = [c for c in text if ord(c) > 0x7F]
        kana = sum("ぁ" <= c <= "ヿ" for c in wide) / max(1, len(wide))
        hangul = sum("가" <= c <= "힣" for c in wide) / max(1, len(wide))
        odd = sum("｡" <= c <= "ﾟ" or "" <= c <= "" for c in wide) / max(1, len(wide))
        shown = 0.5 * (kana > 0.25 if charset in ("euc_jp", "shift_jis") else charset == "euc_kr" and hangul > 0.8)
        score = taken + shown - odd
        if best is None or score > best[0]:
            best = score, charset
    return best


def _cyrillic(head: bytes) -> tuple[float, str]:
    """The best of the Cyrillic encodings: the share of high bytes that are common lower-case letters."""
    best = 0.0, "cp1251"
    for charset in ("cp1251", "koi8_r", "cp866", "iso8859_5"):
        wide = [c for c in head.decode(charset, "replace") if ord(c) > 0x7F]
        score = sum(c in _RUSSIAN for c in wide) / max(1, len(wide))
        if score > best[0]:
            best = score, charset
    return best


def detect_charset(data: bytes | None, head: int = HEAD) -> str:
    """Python's name of the encoding of ``data``, judged by its first ``head`` bytes; UTF-8 if there is no sign of another."""
    first, whole = bytes(data or b"")[:head], len(data or b"") <= head
    for mark, charset in _MARKS:
        if first.startswith(mark):
            return charset
    wide = _wide(first)
    if wide and _decodes(first, wide, whole) is not None:
        return wide
    if _decodes(first, "utf-8", whole) is not None:
        return "utf-8"
    high = sum(b > 0x7F for b in first)
    between = len(re.findall(rb"[A-Za-z][\x80-\xff](?![\x80-\xff])|(?<![\x80-\xff])[\x80-\xff][A-Za-z]", first))
    if between > 0.5 * high:  # single high bytes among Latin letters
        return "cp1252" if _decodes(first, "cp1252", True) is not None and re.search(rb"[\x80-\x9f]", first) else "latin-1"
    double, cyrillic = _double_byte(first, whole), _cyrillic(first)
    if double and double[0] > max(0.75, cyrillic[0]):
        return double[1]
    if cyrillic[0] > 0.4:
        return cyrillic[1]
    return double[1] if double else "latin-1"


def decode_text(data: bytes | None, head: int = HEAD) -> str | None:
    """``data`` as text; bytes beyond the head that are not valid become U+FFFD. Null stays null."""
    return None if data is None else bytes(data).decode(detect_charset(data, head), "replace")
