"""Document search: exact term on a nested array, whole-word match, sorted page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.text import has_word


def has_member(members: Column, name: str) -> Column:
    """Whether an array of structs holds an element with this exact ``name``."""
    return F.exists(members, lambda member: member["name"] == name)


def search(
    documents: DataFrame,
    word: str,
    member: str,
    *,
    text: str = "name",
    members: str = "members",
    score: str = "score",
    ident: str = "id",
    start: int = 0,
    size: int = 20,
) -> DataFrame:
    """Whole documents with the member and the word, best score first. The filters run in the scan stage, and every task
    hands on at most ``start + size`` documents."""
    hits = documents.where(has_member(F.col(members), member)).where(has_word(F.col(text), word))
    return hits.orderBy(F.desc(score), ident).offset(start).limit(size)
