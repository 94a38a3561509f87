from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import EXTRA, SF  # noqa: E402
from overspend.llm.common import importable  # noqa: E402


@pytest.fixture(scope="session")
def docs_of(spark):
    importable(spark)

    def build(rows):
        """rows: (doc_id, text), with extra columns of clashing names."""
        extra = (0.5, 1, "x", "y", 2, "z", "w", 3, b"")
        return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id long, text string, {EXTRA}")

    return build


@pytest.fixture(scope="session")
def sample(spark):
    """Whole documents of the smallest table, in the order of their ids."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"]) for r in rows)


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty and very long texts, a null id, and repeated rows."""
    long = " ".join(f"word{k % 977} number{k % 31}" for k in range(20_000))
    notice = "Released under the MIT License and nothing else at all, as this long line says."
    return [
        (100_001, None),
        (100_002, ""),
        (100_003, "   \n \t "),
        (100_004, long),
        (100_005, long + " end"),
        (100_006, "a b"),
        (100_007, "A  b"),
        (100_008, notice + "\nThis work is licensed under the GNU General Public License, version 3."),
        (100_009, notice + "\nown words of this document"),
        (100_010, "  " + notice.upper() + "\n" + notice),
        (100_011, "Größe, ÀÉ déjà vu ﬁ ½ 日本語 <|endoftext|> it's 42 ́ 힣"),
        (None, notice + "\nwithout an id"),
        (None, None),
        (100_012, "twice the same row " * 9),
        (100_012, "twice the same row " * 9),
    ]
