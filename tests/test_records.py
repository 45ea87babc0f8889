from entitylink.sources import records


def test_pool_is_not_dealt_out_by_country(spark):
    """All later work on the pool ran in one task for each country."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pool = spark.range(90).selectExpr("concat('S2-', id) entity_id", "if(id % 9 = 0, 'Y', 'X') country").repartition(4, "entity_id")
        s1 = spark.createDataFrame([("S1-1", "X"), ("S1-2", "X")], "entity_id string, country string")
        found = records.of_countries(pool, s1)
        assert found.count() == 80
        assert len(found.selectExpr("spark_partition_id() part").distinct().collect()) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
