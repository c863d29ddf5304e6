import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

@pytest.fixture
def messy(spark):
    """Documents with every awkward row of ``brute.MESSY`` and clashing extra columns."""
    from brute import MESSY

    rows = [(doc, text, None if i % 4 == 0 else "en", None if i % 3 == 0 else f"s{i % 3}", i, "clash", "clash")
            for i, (doc, text) in enumerate(MESSY)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size long, "
                                       "bucket string, row string").repartition(3)


@pytest.fixture
def no_documents(messy):
    return messy.limit(0)
