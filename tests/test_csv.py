import pytest

from cardproof.functions.schema import transaction_schema
from cardproof.sources.transactions_csv import read_rejects, read_transactions, scan_csv

SCHEMA = transaction_schema(["V1"])


@pytest.fixture
def csv(tmp_path):
    def write(*lines, header="Time,V1,Amount,Class"):
        path = tmp_path / "in.csv"
        path.write_text("\n".join([header, *lines]) + "\n")
        return str(path)

    return write


def test_clean_rows(spark, csv):
    path = csv("0.0,1.5,10.0,0", "1.0,,20.0,1")
    assert [tuple(r) for r in read_transactions(spark, path, SCHEMA).collect()] == [
        (0.0, 1.5, 10.0, 0), (1.0, None, 20.0, 1),
    ]


@pytest.mark.parametrize(
    "line", ["0.0,1.5", "0.0,1.5,much,0", "0.0,1.5,10.0,0.0", ",1.5,10.0,0", "NaN,1.5,10.0,0", "0.0,1.5,NaN,1"]
)
def test_row_with_a_bad_mandatory_cell_is_rejected(spark, csv, line):
    path = csv(line, "1.0,2.0,3.0,1")
    assert read_transactions(spark, path, SCHEMA).count() == 1
    assert read_rejects(spark, path, SCHEMA).count() == 1


def test_bad_feature_is_null_and_the_row_stays(spark, csv):
    path = csv("0.0,high,10.0,0")
    assert read_transactions(spark, path, SCHEMA).first().V1 is None
    assert read_rejects(spark, path, SCHEMA).count() == 0


def test_extra_cell_is_ignored(spark, csv):
    assert read_transactions(spark, csv("0.0,1.5,10.0,0,9"), SCHEMA).count() == 1


def test_reject_keeps_the_raw_line(spark, csv):
    assert read_rejects(spark, csv("0.0,1.5,much,0"), SCHEMA).first()._raw_line == "0.0,1.5,much,0"


def test_header_names_matter_only_when_strict(spark, csv):
    path = csv("0.0,1.5,10.0,0", header="a,b,c,d")
    assert scan_csv(spark, path, SCHEMA).count() == 1
    with pytest.raises(Exception, match="header does not conform"):
        scan_csv(spark, path, SCHEMA, strict_header=True).collect()
