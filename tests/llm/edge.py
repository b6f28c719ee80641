"""Rows that every operator has to stand: NULLs in any column, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n: int, seed: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) if r.random() < 0.05 else f"w{r.randrange(vocabulary)}" for _ in range(n))


def rows() -> list[tuple]:
    long = words(6000, 1, 5000)
    out = [(i, words(60 + i % 40, i), ("en", "de")[i % 2], f"src{i % 3}", 1) for i in range(10, 60)]
    out += [(100, out[0][1], "en", "src0", 1), (101, out[0][1], None, None, None), (102, None, None, None, None), (103, "", "en", "src1", 0), (104, "  \n\t ", "en", "src1", 0),
            (105, "12 34 !!", "en", "src1", 0), (106, long, "en", "src2", 1), (107, long + " tail", "en", "src2", 1), (108, "x", "en", "src1", 1), (109, "é" * 120, "de", "src1", 1),
            (110, "a" * 500, "en", "src1", 1), (5, "naïve 日本 text here <|endoftext|>  two", "de", None, 1)]
    return out


def repeated() -> list[tuple]:
    return rows() + [rows()[0], rows()[0], (None, words(70, 11), "en", "src0", 1), (None, words(70, 11), "en", "src0", 1), (None, None, None, None, None), (12, words(80, 99), "en", "src1", 1)]


def frame(spark, data):
    """Documents with extra columns whose names clash with operators' own."""
    from pyspark.sql import functions as F

    extra = ["id", "slot", "shard", "fp", "component_id", "score", "rank", "term", "block", "position", "k0", "keys", "value", "mask", "kept", "start"]
    return spark.createDataFrame(data, DOCS).withColumns({c: F.lit("clash") for c in extra})
