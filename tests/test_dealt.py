"""Rows whose texts take long are dealt out to all cores, whatever files they come from."""

from checks import jobs
from redactory.session import dealt
from redactory.streaming.jobs import file_stream


def one_group(spark, tmp_path):
    """Customers in one file of one row group, with a null and a repeated key."""
    keys = [(k, k % 2) for k in range(1, 200)] + [(7, 1), (None, 0)]
    spark.createDataFrame(keys, "c_custkey long, c_nationkey int").coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "PERU"), (1, "CHAD")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    suppliers = [(k, f"Supplier#{k:09d}") for k in range(1, 20)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def test_people_and_contacts_fill_all_cores(spark, tmp_path):
    folder, wanted = one_group(spark, tmp_path), 2 * spark.sparkContext.defaultParallelism
    people, contacts = jobs.people(spark, folder), jobs.contacts(spark, folder)
    assert people.rdd.getNumPartitions() == contacts.rdd.getNumPartitions() == wanted
    assert people.count() == 201 and people.where("user_id = 'u000007'").count() == 2
    assert contacts.select("user_id").distinct().count() == 199
    sizes = [n for n in contacts.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert len(sizes) > wanted / 2


def test_streams_are_dealt_out(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream, out = dealt(file_stream(spark, f"{tmp_path}/in", "*.parquet"), "id"), f"{tmp_path}/out"
    assert stream.isStreaming
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state")
    writer.trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.parquet(out)
    assert rows.count() == 100 and rows.selectExpr("input_file_name() AS f").distinct().count() > 1
