"""Inputs shared by these tests."""

#: Texts that every text operator must take.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "ab", "é", "\U0001f600", "\x00", "a\x1cb", "x" * 50_000,
    "word " * 20_000, "1" * 30_000, "@" * 5_000, "a-" * 5_000, "... " * 3_000,
]
