"""Measures: sums meet the attributes, rows don't move to them."""

import re

import pytest
from pyspark.sql import functions as F

from visitmart.operators.joins import with_related
from visitmart.plans.measures import measure_query
from visitmart.plans.spec import extract
from visitmart.queries import GEO, QUERIES, VISIT_ID, orders, tables


def rows(df):
    return sorted(map(str, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def under_moves_to(df, key):
    """What gives the rows that are moved by this key to meet another table."""
    lines = [re.sub(r"^[ :+-]*", "", line) for line in plan(df).split("\n")]
    return [b for a, b in zip(lines, lines[1:], strict=False) if re.match(rf"Exchange hashpartitioning\(coalesce\({key}#", a)]


@pytest.mark.parametrize("name", ["measure_totals", "measure_value_per_visit", "measure_bounce_rate"])
def test_facts_are_summed_before_they_meet_attributes(spark, data, name):
    """Before, every visit moved to its place's key."""
    moved = under_moves_to(QUERIES[name](spark, data), "GeoId")
    assert moved and all(re.match(r"HashAggregate\(keys=\[GeoId#", x) for x in moved)


def test_sums_of_parts_are_those_of_rows(spark, data):
    """Also by own columns beside related ones, where places are null or missing, and where a fact isn't a whole number."""
    visits = orders(spark, data, ()).withColumn("geo", F.when(F.col("visit_id") % 3 > 0, F.col("geo")))
    value = {"fact": {"select": "visit.value", "name": "Worth"}}
    fields = [{"visit": {"select": "contact_id", "name": "Contact"}}, {"dimension": {"name": "Geo", "fields": GEO}}, "facts", value]
    star = extract(visits, tables({"name": "Visits", "fields": fields}))
    star.tables["Geo"] = star["Geo"].where("Region != 'ASIA'")
    for by in (["Geo.Region"], ["Contact", "Geo.Country", "Geo.Region"]):
        wide = with_related(star, "Visits", by)
        ratio = F.sum("Value").cast("double") / F.sum("Visits").cast("double")
        want = wide.groupBy(*[F.col(f"`{b}`") for b in by]).agg(F.sum("Worth"), ratio, F.sum("Bounces").cast("double") / F.sum("Visits").cast("double"))
        assert rows(measure_query(star, ["Total Worth", "Value per visit", "Bounce rate"], by).toDF(*want.columns)) == rows(want)
    halves = star["Visits"].withColumn("Worth", (F.col("Worth") / 2).alias("Worth", metadata=star["Visits"].schema["Worth"].metadata))
    star.tables["Visits"] = halves.withMetadata("Worth", star["Visits"].schema["Worth"].metadata)
    assert rows(measure_query(star, ["Total Worth"], ["Geo.Region"])) == rows(with_related(star, "Visits", ["Geo.Region"]).groupBy(F.col("`Geo.Region`")).agg(F.sum("Worth").alias("Total Worth")))


def test_visits_of_children_are_summed_before_they_meet_attributes(spark, data):
    """Before, every visit moved to its place's key, and orders were read once more for the visits of all."""
    df = QUERIES["measure_conversion_rate"](spark, data)
    moved = under_moves_to(df, "GeoId")
    assert len(moved) == 1 and re.match(r"HashAggregate\(keys=\[(GeoId|__a0)#", moved[0])
    assert plan(df).count("FileScan parquet [o_orderkey") == 2  # visits, and their children


def test_conversion_by_keys_that_parent_and_child_share(spark, data):
    """The parent's key leads to its attributes and to its children; places may be null or missing."""
    visits = orders(spark, data, ()).withColumn("geo", F.when(F.col("visit_id") % 3 > 0, F.col("geo")))
    child = {"goals": {"name": "Goals", "fields": [{"event": {"select": "name", "name": "Goal"}}, "facts"]}}
    star = extract(visits, tables({"name": "Visits", "fields": [{"date": "Month"}, {"dimension": {"name": "Geo", "fields": GEO}}, "facts"], "tables": [child]}))
    star.tables["Geo"] = star["Geo"].where("Region != 'ASIA'")
    relation = star.parent("Goals")
    for by in (["Geo.Region"], list(relation.to_fields), [relation.to_fields[0], "Geo.Country"], []):
        columns = [F.col(f"`{b}`") for b in by]
        wide = with_related(star, "Visits", by)
        whole = wide.groupBy(*columns).agg(F.sum("Visits").alias("whole"))
        keys = [F.col(k).alias(f"p{i}") for i, k in enumerate(relation.to_fields)]
        up = wide.select(*keys, *[c.alias(f"b{i}") for i, c in enumerate(columns)])
        child_rows = star["Goals"].select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(relation.fields)], F.col("Visits").alias("n"))
        on = F.lit(True)
        for i in range(len(relation.fields)):
            on &= F.col(f"c{i}").eqNullSafe(F.col(f"p{i}"))
        part = {tuple(r)[:-1]: r["n"] for r in child_rows.join(up, on).groupBy(*[f"b{i}" for i in range(len(by))]).agg(F.sum("n").alias("n")).collect()}
        want = sorted(str((*r[:-1], part.get(tuple(r[:-1]), 0) / r[-1])) for r in whole.collect())
        got = measure_query(star, ["Conversion rate (Goals)"], by)
        assert sorted(str(tuple(r)) for r in got.collect()) == want and want
