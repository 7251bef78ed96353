import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)


@pytest.fixture(scope="session")
def docs(spark):
    """Few rows with every odd case: nulls, empty, long, copies, repeated rows, more columns."""
    long = " ".join(f"word{i % 977} and" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the bank of the river", "en", 1.0),
        (2, "The quick brown fox jumps over the lazy dog near the bank of the river", "en", 1.0),
        (2, "The quick brown fox jumps over the lazy dog near the bank of the river", "en", 1.0),
        (3, None, None, None),
        (4, "", "en", 2.0),
        (5, " \n\t ", None, 2.0),
        (6, long, "en", 3.0),
        (7, "日本語のテキスト 'll \x00 \x1c é́ <|endoftext|>  two  spaces ", "ja", 3.0),
        (None, "no key here", "en", 4.0),
        (8, "one", "en", 4.0),
        (9, "a" * 3000 + "  " + "ab" * 900, None, 5.0),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, fp double")
