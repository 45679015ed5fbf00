"""The plans are those one would want on a large cluster."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from carelake.operators import mapping
from carelake.operators.match import Lit, join_order, match
from carelake.plans import bindings, registry, zones

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not there")
SOME = ["q_contraindication", "q_imaging_lab", "q_imaging_lab_bag", "q_abnormal_topk", "bgp_star", "bgp_path"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", SOME)
def test_graph_queries_read_single_predicates_and_join_on_keys(spark, key):
    text = plan(contract.queries()[key](spark, SF_DIR))
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", text)
    assert scans and all(re.search(r"\(p#\d+ = ", s) for s in scans)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_constants_reach_the_scan(spark):
    graph = bindings.stored_graph(spark, SF_DIR)
    text = plan(match(graph, [("?lab", "ont:label", Lit("click"))]))
    assert "EqualTo(o,click)" in text and "EqualTo(o_kind,literal)" in text


def test_scans_skip_node_kinds_that_cannot_match(spark):
    text = plan(contract.queries()["q_contraindication"](spark, SF_DIR))
    assert "StringStartsWith(s,res:allergy/)" in text and "StringStartsWith(s,res:drug/)" in text


def test_top_k_does_not_sort_everything(spark):
    text = plan(contract.queries()["q_abnormal_topk"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in text


def test_scans_read_only_what_is_used(spark):
    text = plan(registry.value_counts(spark, SF_DIR))
    assert "ReadSchema: struct<event_type:string>" in text


def test_fixed_dictionaries_add_no_shuffle(spark):
    text = plan(registry.flag_range(spark, SF_DIR))
    assert text.count("BroadcastHashJoin") == 2
    assert not re.search(r"Exchange (hash|single|range)", text)


def test_no_python_in_the_plans(spark):
    """Image headers are the one thing that Python reads."""
    for key in [*SOME, "integrate_labs", "unify_entities", "surrogate_uid", "quality_profile"]:
        text = plan(contract.queries()[key](spark, SF_DIR))
        assert "Python" not in text and "InPandas" not in text, key


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(df))


def test_mapping_a_clean_table_shuffles_only_its_rows(spark):
    labs = bindings.integrated(spark, SF_DIR, "lab_results").select(F.expr("*"))
    found = exchanges(mapping.map_labs(labs))
    assert len(found) == 2 and all("o_kind" not in e for e in found)


def test_mapping_takes_one_exchange_for_each_kind_of_node(spark):
    images = zones.read_gold(spark, bindings.stored_lake(spark, SF_DIR))["dicom_images"]
    found = exchanges(mapping.map_imaging(images))
    assert len(found) == 3 and sum("node" in e for e in found) == 2 and sum("patient_id_pseudo" in e for e in found) == 1


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("key", ["bgp_star", "sql_over_triples"])
def test_patterns_of_one_subject_need_no_exchange(spark, no_broadcast, key):
    text = plan(contract.queries()[key](spark, SF_DIR))
    assert "SortMergeJoin" in text and "Exchange hashpartitioning" not in text


def test_groups_of_one_subject_shuffle_only_their_counts(spark, no_broadcast):
    found = exchanges(contract.queries()["q_count_by_group"](spark, SF_DIR))
    assert len(found) == 1 and found[0].startswith("modality")


def test_a_path_shuffles_no_side_that_lies_by_its_subject(spark, no_broadcast):
    """The objects of one step are brought to the subjects of the next, which stay."""
    assert len(exchanges(contract.queries()["bgp_path"](spark, SF_DIR))) == 2


def test_selective_numbers_come_before_the_type(spark):
    graph = bindings.stored_graph(spark, SF_DIR)
    patterns = [
        ("?lab", "rdf:type", "ont:LabResult"),
        ("?lab", "ont:label", Lit("click")),
        ("?lab", "ont:hasPatient", "?patient"),
        ("?lab", "ont:value", "?val"),
    ]
    order = [q[1] for q in join_order(graph, patterns, {"val": lambda n: n > 140})]
    assert order.index("ont:value") < order.index("rdf:type")
    assert order[0] in ("ont:value", "ont:label")
    text = plan(contract.queries()["q_abnormal_topk"](spark, SF_DIR))
    # The first scan of the plan is the first of the innermost join.
    joined = [m for m in re.findall(r"p#\d+ = (\S+?)\)", text)]
    assert joined.index("ont:value") < joined.index("rdf:type")
