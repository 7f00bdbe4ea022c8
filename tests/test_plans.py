"""Plan properties that matter at scale, checked on the physical plan (broadcasts disabled so
that small test tables plan like cluster-sized ones)."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_per_page_pipeline_has_no_shuffle(spark, no_broadcast):
    from fixture_pages import course_page
    from gleaner.operators.dom import last_sections, section_headers, section_nodes
    from gleaner.operators.fields import characteristics, contacts
    from gleaner.plans.catalogue import PARSED_SECTIONS, page_nodes
    from gleaner.presets import SectionPreset
    from gleaner.session import co_partition_by_prefix, write_bucketed

    pages = spark.createDataFrame([(i, course_page(str(i), str(i))) for i in range(20)], "page_id long, html string")
    nodes = page_nodes(pages)
    sp = SectionPreset()
    with co_partition_by_prefix(spark):
        headers = section_headers(nodes, sp.header_path, sp.kinds)
        sec = section_nodes(last_sections(headers, PARSED_SECTIONS), nodes)
        assert "Exchange hashpartitioning" not in _plan(sec)
        secn = write_bucketed(sec, "page_id", tag="sections")
        for df in (contacts(secn.filter(F.col("section") == "contacts")),
                   characteristics(secn.filter(F.col("section") == "characteristics"))):
            assert "Exchange hashpartitioning" not in _plan(df)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_scans_are_pruned_and_python_only_parses(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    p = _plan(queries()["q_expanded_view"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in p
    assert "PythonMapInArrow" not in p and "MapInArrow" not in p
    p = _plan(queries()["q_link_select"](spark, sf))
    assert p.count("MapInArrow") == 1
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p
