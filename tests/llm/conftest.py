import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def make_documents(spark):
    """Documents of (doc_id, text), with columns whose names the operators use themselves."""

    def build(*rows):
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, score double, words array<string>, "
            "row_key long, n_tokens int, component_id long, LINES_removed int, block int"
        )
        filled = [(i, text, "en", "s", len(text or ""), None, [], 0, 0, None, None, 1) for i, text in rows]
        return spark.createDataFrame(filled, schema)

    return build
