"""Rules of the settings document, and of generated ids."""

import pytest

from corvane.operators import derive as D
from corvane.operators import quality as X

GOOD = {
    **dict.fromkeys(X.POSITIVE, 5), **dict.fromkeys(X.NOT_NEGATIVE, 0), "status_stale_after_hours": 1.5, "collection_delay_by_group": {"g": 24}, "collection_delay_by_tag": {}, "collection_delay_by_source": {"s": "12"},
    "raw_root": "data/raw", "error_root": "data/errors", "state_file": "data/state.json", "report_root": "reports/daily", "site_root": "site", "report_timezone": "Europe/Kyiv", "sensitive_tags": ["a", "b"], "public_redact_tags": ["a"],
    "x_search_queries": ["q"], "platform_cadence_minutes": {"web": 60}, "minimum_group_counts": {"g": 0}, "article_host_allowlist": {"s": ["a.org", "b.co.uk"]},
}
CASES = [
    ({"workers": "x"}, "workers"), ({"workers": True}, "workers"), ({"x_max_pages": 0}, "x_max_pages"), ({"collection_delay_hours": -1}, "collection_delay_hours"), ({"site_sensitive_delay_hours": None}, "site_sensitive_delay_hours"), ({"status_stale_after_hours": 0}, "status_stale_after_hours"),
    ({"collection_delay_by_tag": []}, "collection_delay_by_tag"), ({"collection_delay_by_group": {"g": -1}}, "collection_delay_by_group.g"), ({"error_root": "/x"}, "error_root"), ({"state_file": "a/../../b"}, "state_file"), ({"report_timezone": "Nowhere"}, "report_timezone"), ({"x_search_queries": "q"}, "x_search_queries"),
    ({"x_search_queries": ["q", " "]}, "x_search_queries[1]"), ({"public_redact_tags": ["z"]}, "public_redact_tags"), ({"platform_cadence_minutes": {"fax": 5}}, "platform_cadence_minutes.fax"), ({"platform_cadence_minutes": {"web": 0}}, "platform_cadence_minutes.web"), ({"platform_cadence_minutes": 5}, "platform_cadence_minutes"),
    ({"minimum_group_counts": {"g": "x"}}, "minimum_group_counts.g"), ({"article_host_allowlist": []}, "article_host_allowlist"), ({"article_host_allowlist": {"s": []}}, "article_host_allowlist"), ({"article_host_allowlist": {"s": ["A.org"]}}, "article_host_allowlist"), ({"article_host_allowlist": {"s": ["localhost"]}}, "article_host_allowlist"),
]


@pytest.mark.parametrize("change, key", CASES)
def test_each_rule(change, key):
    assert [b.split(":")[0] for b in X.settings(GOOD | change, whole=True)] == [key]


def test_a_whole_document():
    assert X.settings(GOOD, whole=True) == [] and len(X.settings({}, whole=True)) == 26


def test_generated_ids(spark):
    made = D.virtual_sources(spark.createDataFrame([(1, "q"), (2, "  "), (3, None), (4, " r ")], "place int, query string"))
    assert sorted((r.source, r.query) for r in made.collect()) == [("x-discovery-1", "q"), ("x-discovery-4", "r")]
    known = spark.createDataFrame([("x-discovery-4",), ("x-discovery-2",)], "source string")
    assert [(r.key, r.rule) for r in X.collisions(known, made).collect()] == [("x-discovery-4", "generated_id")]
