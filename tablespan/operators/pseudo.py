"""Digest columns. They replace a value by a stable token for joining or sharing data; they are no
way to store passwords. Inputs may be of any length."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def md5_upper(c: Column, salt: str = "") -> Column:
    return F.upper(F.md5(F.concat(c, F.lit(salt)) if salt else c))


def sha1_upper(c: Column, salt: str = "") -> Column:
    return F.upper(F.sha1(F.concat(c, F.lit(salt)) if salt else c))
