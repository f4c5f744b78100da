"""Small comparisons shared by the tests."""

import uuid

from stratawell.functions.storage import workspace


def fresh(spark):
    return workspace(spark)


def same_rows(left, right):
    """Equal as multisets of rows, by column name."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def token():
    return uuid.uuid4().hex


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
