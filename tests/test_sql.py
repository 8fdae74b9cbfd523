"""The Spark SQL form of Q1–Q3 returns the same rows as the DataFrame form."""

import pytest

from socialcart import registry
from socialcart.plans import sql as S
from socialcart.sources import testviews as tv
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def views(spark):
    S.register_views(spark, {
        "messages": tv.messages(spark, SF_SMALL),
        "campaigns": tv.campaigns(spark, SF_SMALL), "friends": tv.friends(spark, SF_SMALL),
        "events": tv.events(spark, SF_SMALL), "products": tv.products(spark, SF_SMALL)})


@pytest.mark.parametrize("name, query", [("q1", "q1_campaign_conversion"),
                                         ("q2", "q2_recommendations"),
                                         ("q3", "q3_token_search")])
def test_sql_matches_dataframe(spark, views, name, query):
    got = S.run(spark, name)
    want = registry.queries()[query](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(want.columns)
    assert [tuple(r[c] for c in cols) for r in got.collect()] == \
        [tuple(r[c] for c in cols) for r in want.collect()]
