"""The dashboards as SQL text give what the DataFrame plans give."""

import math

import pytest

from reelhouse.plans import dashboards
from reelhouse.plans.standins import Staged

SF = "/root/testdata/sf0.001"
PLANS = {
    "avg_by_genre_platform": (dashboards.avg_by_genre_platform, {}),
    "avg_by_company": (dashboards.avg_by_company, {"roles": ["developer"]}),
    "avg_by_year": (lambda s: dashboards.avg_by_year(s, critics=True), {"critics": True}),
    "avg_by_name_match": (lambda s: dashboards.avg_by_name_match(s, "MACH"), {"word": "MACH"}),
    "best_genre_per_company": (dashboards.best_genre_per_company, {}),
    "company_roles": (dashboards.company_roles, {}),
    "company_score_bands": (dashboards.company_score_bands, {"roles": ["developer"]}),
}


def plain(df):
    return sorted(
        tuple(float(f"{v:.9g}") if not isinstance(v, (str, int, type(None))) and not math.isnan(v) else v for v in r)
        for r in df.collect()
    )


def test_every_text_has_a_plan():
    assert set(PLANS) == set(dashboards.SQL)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_text_and_plan_agree(spark, name):
    from pyspark.sql import functions as F

    star = Staged.of(spark, SF)
    for table in star:
        star[table].createOrReplaceTempView(table)
    plan, args = PLANS[name]
    bound = {k: F.array(*map(F.lit, v)) if isinstance(v, list) else v for k, v in args.items()}
    assert plain(spark.sql(dashboards.SQL[name], args=bound)) == plain(plan(star))
