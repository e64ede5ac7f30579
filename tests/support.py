"""Inputs and helpers that several test modules share."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


def explain(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
