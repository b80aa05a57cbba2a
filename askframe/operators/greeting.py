"""Next-year greetings from request lines ``<name> <age>``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askframe.functions.fields import next_number, split_line, whole_number
from askframe.functions.messages import GREETING, fill


def read_fields(requests: DataFrame, line: str = "line") -> DataFrame:
    """Adds ``name``, ``age_text`` and ``age``. ``line`` is dropped."""
    name, rest = split_line(F.col(line))
    fields = requests.withColumns({"name": name, "age_text": rest}).drop(line)
    return fields.withColumn("age", whole_number(F.col("age_text")))


def greet(requests: DataFrame, line: str = "line", template: str = GREETING) -> DataFrame:
    """One answer per request: a projection, no shuffle.

    Only decimal integers are ages. Anything else, and an age whose successor
    does not fit, is answered with ``status = 'bad_age'`` and a NULL message.
    """
    fields = read_fields(requests, line).withColumn("age_next", next_number(F.col("age")))
    return fields.withColumns(
        {
            "message": fill(template, name=F.col("name"), age_next=F.col("age_next")),
            "status": F.when(F.col("age_next").isNull(), "bad_age").otherwise("ok"),
        }
    )
