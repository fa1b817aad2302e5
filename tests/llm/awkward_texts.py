"""Texts that every operator must take."""

AWKWARD = [
    None, "", " ", "\n\t\x0b\x0c\r", "x", "a a a a a a a a a", "\x00\x00 \x00", "é ü ß", "日本語 テキスト 😀",
    "No space" * 300, "word " * 3000, "1" * 5000, "a@b.c " * 50,
]
