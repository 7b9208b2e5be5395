"""Texts brought to plain words: markup, escapes, invisible characters, case and punctuation removed."""

from __future__ import annotations

import html
import re
import unicodedata
from itertools import accumulate
from urllib.parse import unquote

_ESCAPE = re.compile(r"\\+(?:u([0-9a-fA-F]{4})|u\{([0-9a-fA-F]{1,6})\}|x([0-9a-fA-F]{2})|[nrtbfv]|[\"'/])|\\+")
_TAG = re.compile(r"<[/!?]?[a-zA-Z!?/-][^<>]{0,400}>")
_QUOTED_LINE = re.compile(r"=\r?\n")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_HYPHENATED = re.compile(r"(?<=\w)[-‐‑¬]\s*[\r\n]+[ \t>|#*]*(?=\w)")
_WORD = re.compile(r"[^\W_]+")

#: Characters that show nothing: format characters, fillers, variation selectors and combining marks.
INVISIBLE = {c: None for c in range(0x110000 >> 4) if unicodedata.category(chr(c)) in ("Cf", "Mn", "Me", "Cs")}
INVISIBLE |= {c: None for c in (0x115F, 0x1160, 0x3164, 0xFFA0, *range(0xE0000, 0xE0080), *range(0xE0100, 0xE01F0))}
_PLAIN = re.compile(r"[\x00-\x7f]*")


def _escaped(m: re.Match) -> str:
    code = m[1] or m[2] or m[3]
    if not code:
        return " "
    n = int(code, 16)
    return chr(n) if n < 0x110000 and not 0xD800 <= n < 0xE000 else " "


def repaired(text: str) -> str:
    """UTF-8 that was read as Latin-1 or Windows-1252, read as UTF-8 again; other text unchanged."""
    if "Ã" not in text and "Â" not in text and "â€" not in text:
        return text
    pairs = lambda m: _reread(m[0])
    return re.sub(r"[\u00c2-\u00f4][\u0080-\u00bf\u0152\u0153\u0160\u0161\u0178\u017d\u017e\u0192\u02c6\u02dc\u2013-\u203a\u20ac\u2122]{1,3}", pairs, text)


def _reread(text: str) -> str:
    for page in ("cp1252", "latin-1"):
        try:
            return text.encode(page).decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            continue
    return text


def unwrapped(text: str) -> str:
    """The text without markup, escapes and invisible characters; what separated words still separates them."""
    if "&" in text:
        for _ in range(3):
            new = html.unescape(text)
            if new == text:
                break
            text = new
    if "\\" in text:
        text = _ESCAPE.sub(_escaped, text)
    if "=\n" in text or "=\r" in text:
        text = _QUOTED_LINE.sub("", text)
    if "%" in text:
        text = _PERCENT.sub(lambda m: unquote(m[0], errors="replace"), text)
    if "<" in text:
        text = _TAG.sub(_tag, text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", repaired(text)).translate(INVISIBLE)
    return text


def _tag(m: re.Match) -> str:
    """Tags that break lines separate words; others may stand within one."""
    return " " if re.match(r"</?(?:br|p|div|li|ul|ol|td|tr|th|table|h\d|hr|pre|blockquote|section)\b", m[0], re.I) else ""


def words(text: str) -> list[str]:
    """Lower-case words of letters and digits; words broken at line ends are joined where a hyphen shows it."""
    text = unwrapped(text)
    if "\n" in text:
        text = _HYPHENATED.sub("", text)
    return _WORD.findall(text.lower())


def bounds(tokens: list[str]) -> set[int]:
    """Where words begin and end in the concatenated words."""
    return {0, *accumulate(map(len, tokens))}
