"""Hand-made transactions for the tests."""

from cardproof.functions.schema import FEATURES, transaction_schema


def transaction(time=0.0, amount=100.0, label=0, **features):
    values = {name: float(i + 1) for i, name in enumerate(FEATURES)} | features
    return (time, *[values[name] for name in FEATURES], amount, label)


def frame(spark, *rows):
    return spark.createDataFrame([transaction(*r) if len(r) <= 3 else r for r in rows], transaction_schema())
