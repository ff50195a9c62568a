"""CSV straight into the batch job's input: `_seq` is the order of the lines."""

from riskgraph.sources import files


def test_read_transactions_numbers_lines_in_file_order(spark, tmp_path):
    header = "transaction_id,timestamp,amount,account_id,merchant_id,device_id,is_fraud\n"
    for name, first in (("b.csv", 100), ("a.csv", 0)):
        lines = [f"t{first + i:04d},2024-01-01 10:00:00,{i + 1}.5,acc{i % 3},m1,d1,0\n" for i in range(50)]
        (tmp_path / name).write_text(header + "".join(lines))
    df = files.read_transactions(spark, str(tmp_path))
    got = [r["transaction_id"] for r in df.orderBy("_seq").collect()]
    assert got == [f"t{i:04d}" for i in range(50)] + [f"t{100 + i:04d}" for i in range(50)]
    assert sorted(r["_seq"] for r in df.select("_seq").collect()) == list(range(100))
