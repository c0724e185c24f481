import sys
from pathlib import Path

import pytest
from llm_texts import prose

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, size STRING, draw STRING, __x STRING"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, copies, repeated rows, and columns named like the operators' own."""
    texts = [prose(k, 30 + 7 * k) for k in range(40)]
    rows = [(k, t, ["en", "de", None][k % 3], ["a", "b", "c", None][k % 4], len(t)) for k, t in enumerate(texts)]
    rows += [(40, None, "en", "a", None), (41, "", "en", "a", 0), (42, " \n\t ", None, None, 4), (None, texts[3], None, "b", None)]
    rows += [(43, prose(99, 60_000), "en", "b", None), (44, "x" * 200_000, "en", "b", 200_000)]
    rows += [(45, texts[5], "en", "a", None), (46, texts[5], "en", "c", None), (5, texts[5], "de", "b", None)]
    rows += [(47, texts[7] + " one more", "en", "a", None), (48, "one two three", "en", "a", None), (49, "one two three", "en", "b", None)]
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
