"""Words of digits, letters and non-ASCII characters, as bytes, from texts of any length."""

from __future__ import annotations

from collections.abc import Iterator

TEXT_BYTES = 4 << 20  # text handled at once

# 0-9, a-z and bytes over 0x7F are word bytes, A-Z become a-z, all others separate words
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def word_parts(text: bytes | None) -> Iterator[bytes]:
    """The text's words, lower-cased and parted by spaces, in parts of bounded size cut between words."""
    text = (text or b"").translate(WORD_BYTES)
    at = 0
    while at < len(text):
        cut = len(text) if at + TEXT_BYTES >= len(text) else text.find(b" ", at + TEXT_BYTES)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut]
        at = cut
