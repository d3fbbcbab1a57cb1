"""Small tables with every awkward case, shared by the operators' tests."""

from __future__ import annotations

import pandas as pd

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "key long, node long, n string, rest int, seq long, `odd name` string"

PROSE = " ".join(f"word{i % 37}x{i * 7 % 101}" for i in range(120))


def odd_rows() -> list[tuple]:
    texts = {
        1: PROSE,
        2: PROSE,
        3: PROSE + " one more word here",
        4: None,
        5: "",
        6: "  \t\n ",
        7: "one",
        8: "ONE",
        9: "two words",
        10: "long " * 30_000,
        11: "x" * 50_000,
        12: "Ünïcode ▁ mark, <|endoftext|> and \U0001f600 there",
        13: PROSE.upper(),
        14: " ".join(PROSE.split()[40:80]) + " and then an end of its own which nobody else has at all ok",
    }
    rows = [(d, t, "en", "src0", None if t is None else len(t)) for d, t in texts.items()]
    return rows + [(14, texts[14], None, None, None), (None, PROSE, None, None, None), (None, None, None, None, None)]


def odd_docs(spark, with_clashes: bool = False):
    rows = odd_rows()
    if with_clashes:
        return spark.createDataFrame([(*r, 1, 2, "n", 3, 4, "z") for r in rows], f"{DOC}, {CLASHES}")
    return spark.createDataFrame(rows, DOC)


def no_docs(spark):
    return spark.createDataFrame([], DOC)


def small(spark, table: str, folder: str = SMALL):
    return spark.read.parquet(f"{folder}/{table}.parquet")


def rows_of(df) -> pd.DataFrame:
    return df.toPandas()
