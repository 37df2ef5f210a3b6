"""Small frames shared by the tests."""

from contextlib import contextmanager

from keyframe.model import ForeignKey, KeyModel

VERSIONED = "ValidFromVersion int, ValidToVersion int, Country int, Year int, val double"


def rows(frame):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def versions_dim(spark):
    return spark.createDataFrame([(n, f"v{n}") for n in range(1, 11)], "VersionID int, Version string")


def countries_dim(spark):
    return spark.createDataFrame([(1, "NZL"), (2, "PER"), (3, "KEN")], "CountryID int, Country string")


def versioned_model(spark, fact="Fact"):
    structs = {
        fact: spark.createDataFrame([], VERSIONED).schema,
        "Version": versions_dim(spark).schema,
        "Country": countries_dim(spark).schema,
    }
    return KeyModel(
        structs,
        {
            fact: ("ValidFromVersion", "ValidToVersion", "Country", "Year"),
            "Version": ("VersionID",),
            "Country": ("CountryID",),
        },
        (
            ForeignKey(fact, "ValidFromVersion", "Version", "VersionID", "Version"),
            ForeignKey(fact, "ValidToVersion", "Version", "VersionID", "Version"),
            ForeignKey(fact, "Country", "Country", "CountryID", "Country"),
        ),
    )


def dims(spark):
    return {"Version": versions_dim(spark), "Country": countries_dim(spark)}


def schema_row(table, column, is_pk, kind, fk_table="NA", fk_column="NA"):
    return {
        "Table": table,
        "Colname": column,
        "IsPK": is_pk,
        "ColDataType": kind,
        "FKTable": fk_table,
        "FKColname": fk_column,
    }


BAND_SCHEMA = [
    schema_row("Player", "PlayerID", True, "int"),
    schema_row("Player", "Player", False, "text"),
    schema_row("Part", "PartID", True, "int"),
    schema_row("Part", "Part", False, "text"),
    schema_row("PlayerPart", "Player", True, "int", "Player", "PlayerID"),
    schema_row("PlayerPart", "Part", False, "int", "Part", "PartID"),
]


def band(spark):
    """Model and dimension tables of a small quartet."""
    players = spark.createDataFrame(
        [(1, "Ana"), (2, "Bo"), (3, "Cy"), (4, "Dee")], "PlayerID int, Player string"
    )
    parts = spark.createDataFrame(
        [(1, "Violin"), (2, "Viola"), (3, "Cello"), (4, "Bass")], "PartID int, Part string"
    )
    return KeyModel.from_schema_table(BAND_SCHEMA), {"Player": players, "Part": parts}


@contextmanager
def settings(spark, values):
    """Session settings for the length of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Small limits that make adaptive execution treat test data like large data.
LARGE_DATA = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
