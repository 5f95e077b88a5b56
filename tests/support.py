"""What tests of several modules share. It is not a conftest, whose name another folder's could shadow."""

TESTDATA = "/root/testdata"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
