"""Text rules shared by operators, as plain Python on one value (used inside Arrow batches)."""

from __future__ import annotations

import html
import json
import re
import unicodedata

MARKUP = re.compile(r"<[^>]+>")
#: Fields of a raw posting that hold its body, in order of preference (fixed values).
BODY_FIELDS = ("content", "description", "descriptionHtml")


def strip_markup(text: str | None, unescape: int = 2) -> str:
    """Character entities decoded ``unescape`` times, then every ``<...>`` deleted."""
    if not text:
        return ""
    for _ in range(unescape):
        if "&" not in text:
            break
        text = html.unescape(text)
    return MARKUP.sub("", text) if "<" in text else text


def body_of(raw_json: str | None) -> str:
    """The body of a raw posting; '' when there is none or the JSON cannot be read."""
    if not raw_json:
        return ""
    try:
        raw = json.loads(raw_json)
    except ValueError:
        return ""
    if not isinstance(raw, dict):
        return ""
    for field in BODY_FIELDS:
        value = raw.get(field)
        if value and isinstance(value, str):
            return strip_markup(value)
    return ""


def fold(text: str | None) -> str:
    """Compatibility form without marks, ASCII, lower case, single spaces between runs of a-z0-9."""
    if not text:
        return ""
    plain = unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode().lower()
    return re.sub(r"[^a-z0-9]+", " ", plain).strip()
