from tessera.plans.sensors import band_readings, hvac_building, hvac_reliability


def test_bands_boundaries_and_null(spark):
    hvac = spark.createDataFrame([(1, 20, 14.0), (1, 20, 15.0), (2, 20, 25.0), (2, 20, 26.0), (3, 20, None)],
                                 "BuildingID int, TargetTemp int, ActualTemp double")
    got = [(r.temprange, r.extremetemp) for r in band_readings(hvac).collect()]
    assert got == [("COLD", 1), ("NORMAL", 0), ("NORMAL", 0), ("HOT", 1), ("NORMAL", 0)]


def test_left_join_unmatched_and_fanout(spark):
    hvac = spark.createDataFrame([(1, 20, 30.0, "s", 3), (9, 20, 20.0, "t", 4), (None, 20, 20.0, "u", 5)],
                                 "BuildingID int, TargetTemp int, ActualTemp double, System string, SystemAge int")
    b = spark.createDataFrame([(1, "FR", "P1", "M1"), (1, "DE", "P2", "M2")],
                              "BuildingID int, Country string, HVACproduct string, BuildingMgr string")
    out = hvac_building(hvac, b)
    assert out.columns == ["TargetTemp", "ActualTemp", "System", "SystemAge", "temp_diff", "temprange",
                           "extremetemp", "Country", "HVACproduct", "BuildingMgr"]
    got = sorted((r.System, r.Country) for r in out.collect())
    assert got == sorted([("s", "FR"), ("s", "DE"), ("t", None), ("u", None)], key=repr)
    rel = {(r.Country, r.HVACproduct): (r.readings, r.extreme_readings) for r in hvac_reliability(hvac, b).collect()}
    assert rel[("FR", "P1")] == (1, 1) and rel[(None, None)] == (2, 0)
