"""What the physical plans must and must not do."""

import re

from pyspark.sql import functions as F

from carrel.functions.marc import PROVIDER_FIELD
from carrel.operators import dedupe, orders, reconcile
from carrel.session import stage
from carrel.sources.marc21 import encode, first_values, parse, read_pieces, with_record_index
from carrel.sources.marcxml import read_marcxml
from queries import inputs
from queries.registry import QUERIES
from tests.helpers import collection, marc21, xml_record

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lambdas(df):
    """How often higher-order functions are evaluated, as a measure of copies."""
    return len(re.findall(r"lambdafunction\(|from_xml\(|xmltostructs", plan_of(df).lower()))


def pieces(spark, tmp_path):
    (tmp_path / "a.ord").write_bytes(marc21(1, "DEG") + marc21(2, "EBS"))
    return read_pieces(spark, str(tmp_path))


def test_filters_do_not_parse_again(spark, tmp_path):
    parsed = parse(pieces(spark, tmp_path))
    kept = parsed.where("parse_error is null and record.leader is not null")
    assert lambdas(kept.select("raw", "record")) <= lambdas(parsed.select("raw", "record"))

    routed = orders.with_provider(parsed)
    assert lambdas(routed.where("provider = 'DEG'")) <= lambdas(routed)

    (tmp_path / "c.xml").write_text(collection(xml_record(1)))
    xml = read_marcxml(spark, str(tmp_path / "c.xml"))
    assert lambdas(xml.where("parse_error is null")) <= lambdas(xml)

    made = encode(parsed.select("record"), raw="made")
    assert lambdas(made.where("octet_length(made) > 9")) <= lambdas(made)


def test_orders_are_published_without_a_shuffle(spark, tmp_path):
    rows = pieces(spark, tmp_path)
    checked = orders.with_provider(first_values(rows, provider_value=PROVIDER_FIELD))
    counts = orders.count_by_provider(checked)
    outputs = orders.planned_outputs(counts, orders.rejected_files(counts), 2026)
    outputs = stage(outputs.withColumn("exists", F.lit(False)), "outputs")
    routed = orders.with_provider(
        first_values(rows, checked=False, provider_value=PROVIDER_FIELD)
    )
    plan = plan_of(orders.records_to_publish(routed, outputs))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert "SortAggregate" not in plan_of(counts)


def test_record_index_counts_before_parsing(spark, tmp_path):
    plan = plan_of(parse(with_record_index(pieces(spark, tmp_path))))
    assert plan.count("Generate explode") == 1 and "Window" not in plan


def test_only_needed_columns_are_read(spark):
    plan = QUERIES["image_fit"](spark, SF)._jdf.queryExecution().toString()
    (schema,) = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert "l_shipdate" not in schema and "l_discount" not in schema
    assert schema.count(":") == 5


def test_distinct_names_are_joined_on_their_partitioning(spark):
    pages = inputs.table(spark, SF, "pages")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(
            reconcile.reconcile(inputs.local_names(pages), reconcile.catalog_names(pages), "both")
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_keys_are_aggregated_before_the_shuffle(spark):
    events = inputs.table(spark, SF, "events")
    plan = plan_of(dedupe.last_wins(events, ["user_id"], ["event_id"]))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_max_by" in plan
    assert "Window" not in plan
