import pytest
from pyspark.sql import functions as F

from blotter.functions.classify import (
    CHICAGO_CATEGORIES,
    DC_CATEGORIES,
    category,
    group_starts_with,
    offense_in,
)

CHICAGO_CASES = {
    "THEFT": "Theft",
    "Theft/other": "Theft",
    "MOTOR VEHICLE THEFT": "Motor Vehicle Theft",
    "theft of motor": "Motor Vehicle Theft",
    "motor": "Other",
    "BATTERY": "Violent Crime",
    "Assault": "Violent Crime",
    "CRIMINAL DAMAGE": "Violent Crime",
    "aggravated assault": "Other",
    "ROBBERY": "Robbery",
    "BURGLARY": "Burglary",
    "HOMICIDE": "Other",
    "robbery ": "Other",
    "": "Other",
    None: "Other",
}
DC_CASES = {
    "THEFT F/AUTO": "Theft",
    "MOTOR VEHICLE THEFT": "Motor Vehicle Theft",
    "theft of motor": "Other",
    "ASSAULT W/DANGEROUS WEAPON": "Violent Crime",
    "Robbery": "Violent Crime",
    "HOMICIDE": "Violent Crime",
    "assault": "Other",
    "BURGLARY": "Burglary",
    "SEX ABUSE": "Sex Crime",
    "ARSON": "Other",
    "": "Other",
    None: "Other",
}


@pytest.mark.parametrize(
    "rules, cases", [(CHICAGO_CATEGORIES, CHICAGO_CASES), (DC_CATEGORIES, DC_CASES)]
)
def test_categories(spark, rules, cases):
    df = spark.createDataFrame([(text,) for text in cases], "x string")
    got = {r[0]: r[1] for r in df.select("x", category(F.col("x"), rules)).collect()}
    assert got == cases


def test_violence_rules(spark):
    df = spark.createDataFrame(
        [("Robbery", "Violent"), ("ROBBERY ", "nonviolent"), (None, None)],
        "offense_type string, offense_group string",
    )
    by_name = [r[0] for r in df.select(offense_in(("ROBBERY",))()).collect()]
    by_group = [r[0] for r in df.select(group_starts_with("violent")()).collect()]
    assert by_name == [True, False, None]
    assert by_group == [True, False, None]
