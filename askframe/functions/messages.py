"""Answer texts and the one helper that fills them."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Users compare answers with these texts, letter by letter.
GREETING = "Привет, {name}! Через год тебе будет {age_next} лет."
FILE_FOUND = "Файл '{pattern}' найден"
FILE_MISSING = "Файл '{pattern}' не найден"
SNAPSHOT_DIR_MISSING = "Дирректория '{dir}' не найдена!"
SNAPSHOT_DONE = "Архив создан: {archive_name}"
BACKUP_DIR_MISSING = "Директория не найдена!"
BACKUP_PREFIX = "backup_"
ARCHIVE_SUFFIX = ".tar.gz"


def fill(template: str, **values: Column) -> Column:
    """The template with its ``{fields}`` filled; NULL if any used value is NULL."""
    pieces = []
    for text, field, _, _ in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field:
            pieces.append(values[field].cast("string"))
    return F.concat(*pieces)
