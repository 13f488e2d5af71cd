"""The cut into entries as an Arrow UDF, to compare with the column form.

Only this one step moves to Python; all typed columns stay column expressions.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flarebook.functions import notice_text as t


def with_arrow_entries(frame: DataFrame, payload: str = "payload") -> DataFrame:
    # Plain local values, so that workers need no package of ours installed.
    cut = re.compile(f"{t.LINE_END}(?={t.FIELD_NAME}:)")
    no_break_space, wide_line_ends = t.NO_BREAK_SPACE, t.WIDE_LINE_ENDS

    @F.pandas_udf("array<string>")
    def cut_entries(payloads: pd.Series) -> pd.Series:
        text = "\n" + payloads.fillna("").str.replace(no_break_space, " ", regex=False)
        for wide in wide_line_ends:
            text = text.str.replace(wide, "\n", regex=False)
        return text.map(lambda notice: cut.split(notice)[::-1])

    with_cut = frame.withColumn(t.ENTRIES, cut_entries(F.col(payload)))
    return with_cut.withColumn(t.NAMES, t.names(F.col(t.ENTRIES)))
