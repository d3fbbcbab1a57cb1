import pytest

from ledgerlens.errors import LogReadError
from ledgerlens.schema import TRANSACTION_SCHEMA
from ledgerlens.sources.log import read_log


def test_reads_a_valid_log(spark, csv, dict_rows):
    df = read_log(spark, csv(dict_rows))
    assert df.schema == TRANSACTION_SCHEMA
    assert df.count() == 60


def test_column_order_of_the_file_does_not_matter(spark, csv, dict_rows):
    columns = list(reversed(TRANSACTION_SCHEMA.names))
    assert read_log(spark, csv(dict_rows, columns)).orderBy("step").first().amount == 100.0


def test_nrows_keeps_the_first_steps(spark, csv, dict_rows):
    assert sorted(r.step for r in read_log(spark, csv(dict_rows), nrows=5).collect()) == [1, 2, 3, 4, 5]


def test_whole_numbers_pass_as_decimals(spark, csv, dict_rows):
    for r in dict_rows:
        r["amount"] = int(r["amount"])
    assert read_log(spark, csv(dict_rows)).first().amount == 100.0


def test_gap_in_a_balance_is_a_gap(spark, csv, dict_rows):
    dict_rows[0]["amount"] = None
    assert read_log(spark, csv(dict_rows)).where("amount IS NULL").count() == 1


def refuse(spark, path, words):
    with pytest.raises(LogReadError, match=words):
        read_log(spark, path)


def test_missing_file(spark, tmp_path):
    refuse(spark, str(tmp_path / "nothing.csv"), "cannot read")


def test_missing_column(spark, csv, dict_rows):
    refuse(spark, csv(dict_rows, [c for c in TRANSACTION_SCHEMA.names if c != "amount"]), "amount")


def test_no_rows(spark, csv):
    refuse(spark, csv([]), "no rows")


def test_empty_file(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("")
    refuse(spark, str(path), "header")


def test_unknown_type(spark, csv, dict_rows):
    dict_rows[3]["type"] = "GIFT"
    refuse(spark, csv(dict_rows), "GIFT")


@pytest.mark.parametrize(
    ("column", "value"),
    [("amount", "much"), ("step", "1.5"), ("step", None), ("isFraud", "yes"), ("isFraud", None)],
)
def test_wrong_types(spark, csv, dict_rows, column, value):
    dict_rows[7][column] = value
    refuse(spark, csv(dict_rows), column)


def test_ids_that_are_all_numbers(spark, csv, dict_rows):
    for i, r in enumerate(dict_rows):
        r["nameOrig"] = i
    refuse(spark, csv(dict_rows), "nameOrig")


def test_line_with_too_many_fields(spark, csv, dict_rows):
    path = csv(dict_rows)
    with open(path, "a") as f:
        f.write("1,PAYMENT,1.0,C1,1.0,1.0,M1,1.0,1.0,0,0,99\n")
    refuse(spark, path, "broken")


def test_part_files_with_another_header_are_refused(spark, csv, dict_rows, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    columns = list(TRANSACTION_SCHEMA.names)
    csv(dict_rows[:30], columns, "parts/a.csv")
    i, j = columns.index("amount"), columns.index("oldbalanceOrg")
    columns[i], columns[j] = columns[j], columns[i]
    csv(dict_rows[30:], columns, "parts/b.csv")
    refuse(spark, str(folder), "parse|header")


def test_part_files_with_one_header(spark, csv, dict_rows, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    csv(dict_rows[:30], name="parts/a.csv")
    csv(dict_rows[30:], name="parts/b.csv")
    assert read_log(spark, str(folder)).count() == 60


def test_all_unknown_types_are_named(spark, csv, dict_rows):
    for i in range(30):
        dict_rows[i]["type"] = f"GIFT{i}"
    refuse(spark, csv(dict_rows), "GIFT29")
