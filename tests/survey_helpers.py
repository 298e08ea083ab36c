"""Helpers of the tests, in a module of its own name: every folder of tests may have its conftest."""

from pyspark.sql import functions as F

from surveyqa import schemas


def rows(df, *columns):
    """Rows as sorted tuples, NULL last."""
    chosen = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df
    return sorted(
        (tuple(r) for r in chosen.collect()), key=lambda r: [(v is None, str(v)) for v in r]
    )


def rule(condition, code="C1", analyst="Ana", chapter=1, section="A"):
    return (condition, chapter, section, 1, f"definición {code}", code, analyst)


def rule_sheet(spark, *rules):
    return spark.createDataFrame(list(rules), schemas.RULES)
