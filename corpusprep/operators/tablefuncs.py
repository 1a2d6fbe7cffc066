"""Python table functions."""

from __future__ import annotations

from pyspark.sql.functions import udtf


@udtf(returnType="window_id: int, start: int, ids: array<int>")
class QaWindows:
    """Windows of ``size`` ids advancing by ``step``; stops at the first window that reaches the end
    (the window rule of Q5): [1..7], size 4, step 2 -> [1,2,3,4] [3,4,5,6] [5,6,7]."""

    def eval(self, ids, size: int, step: int):
        if ids is None or size <= 0 or step <= 0:
            return
        start, wid = 0, 0
        while True:
            yield wid, start, list(ids[start:start + size])
            if start + size >= len(ids):
                break
            start += step
            wid += 1


def register_qa_windows(spark, name: str = "qa_windows"):
    spark.udtf.register(name, QaWindows)
    return QaWindows
