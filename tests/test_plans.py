"""Plan lint: no registered query may contain a cartesian product or a nested-loop join, and every
scan of a parquet table reads only the columns the query needs."""

import io
import contextlib

import pytest

from corpusprep.plans import all_queries as queries
from tests.conftest import SF0001

# Streaming queries finish inside the call and return a re-read of their sink.
QUERIES = sorted(queries())


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue()


@pytest.mark.parametrize("name", QUERIES)
def test_no_pair_products(spark, name):
    txt = plan_text(queries()[name](spark, SF0001))
    assert "CartesianProduct" not in txt
    assert "BroadcastNestedLoopJoin" not in txt
    assert "CrossJoin" not in txt.replace("spark.sql.crossJoin", "")


def test_projection_reaches_scan(spark):
    txt = plan_text(queries()["doc_words_by_lang"](spark, SF0001))
    assert "ReadSchema: struct<text:string,lang:string>" in txt
    txt = plan_text(queries()["recent_events"](spark, SF0001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,value:double>" in txt
