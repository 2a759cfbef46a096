"""Plan text, for the tests that pin a plan's shape."""


def final_plan(df):
    """The adaptive plan of a frame that has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def static_plan(df):
    """The physical plan before it runs."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
