import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from termlift.session import session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    made = session(
        "tests",
        "local[*]",
        spark__driver__memory="8g",
        spark__sql__shuffle__partitions="8",
        spark__termlift__inputPartitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture(scope="session")
def reviews(spark):
    from termlift.sources.reviews import as_reviews
    from termlift.sources.tables import table

    return as_reviews(table(spark, TESTDATA, "documents"), "lang", "text", "doc_id")


@pytest.fixture(scope="session")
def features(reviews):
    from termlift.catalog.settings import STOP_WORDS
    from termlift.plans.feature_ranking import build_features

    return build_features(reviews, STOP_WORDS, size=300)
