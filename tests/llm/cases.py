"""Small tables that the tests of this folder share."""

ODD_TEXTS = [
    None, "", " ", "   ", "\n", "a", "a b", " a", "a ", "a  b ", "a\n\nb", "x\ty", "it's we'll they're I'm 'd ''s", "\x00\x01a", " x y　z",
    "é é ﬁ ①", "日本語 テキスト", "😀😀 👩‍👩‍👧", "▁▁a▁b ▁", "<s></s><unk><|endoftext|>", "<0x0A>", "1234567890 12 3", "\x1c\x1d\x85 a\x1fb", "a\r\nb\r\n", "ÄÖÜ ß ΑΒΓ дом", "x" * 3000, "ab " * 4000, " \n" * 500,
    "​﻿᠎ q", "a'S DON'T", "٣٤ ²③ Ⅷ",
]


def odd_docs(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(1, "again"), (5, "a"), (5, "a"), (None, "no id")]
    return spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, n_tokens string, id int")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
