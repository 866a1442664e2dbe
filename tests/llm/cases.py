"""Awkward rows that every operator must take: nulls, empty and long texts, repeats, clashing extra columns."""

from __future__ import annotations

import pyarrow.parquet as pq

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, part int, tokens string, sid string, keys int, label string, slot int"
WORDS = "the of and stone river green walks under light home every small paper window".split()


def words(n: int, seed: int = 0) -> str:
    return " ".join(WORDS[(i * i + seed * 7 + i * seed) % len(WORDS)] + str((i * 31 + seed) % 97) for i in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    long = words(30_000, 3)
    base = words(60, 1)
    return [
        (1, base),
        (2, base),
        (3, base + " tail"),
        (4, None),
        (5, ""),
        (6, "   \n\t "),
        (7, "x"),
        (8, "12 34 !!"),
        (9, long),
        (10, long + " end"),
        (None, words(20, 9)),
        (None, None),
        (11, "ZÜRICH straße日本語 \U0001f600 <|endoftext|> a\u2003b  c\r\n"),
        (12, words(5, 2)),
        (12, words(5, 2)),
        (12, words(40, 5)),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", "s", len(t or ""), 0.5, 1, "t", "s", 2, "l", 3) for i, t in rows]
    return spark.createDataFrame(full, DOCUMENTS).repartition(3)


def stored(spark, tmp_path, **tables) -> str:
    """A folder with the given DataFrames as tables."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def sample(folder: str = "/root/testdata/sf0.001", table: str = "documents"):
    return pq.read_table(f"{folder}/{table}.parquet").to_pylist()
