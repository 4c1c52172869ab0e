"""Predicates with SQL three-valued logic, and the element classes built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ElementVocabulary


def starts_with(col: Column | str, prefix: str | None) -> Column:
    """``col LIKE 'prefix%'``; pushed to parquet / JDBC as ``StringStartsWith``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lit(True) if prefix is None else c.startswith(prefix)


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds, F.lit(True))


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds, F.lit(False))


class ElementClasses:
    """Class predicates over (kind, note, uso); NULL inputs follow SQL 3VL, so the
    classes overlap and do not partition the rows."""

    def __init__(self, vocab: ElementVocabulary, kind: str = "kind", note: str = "note", uso: str = "uso"):
        self.v = vocab
        self.kind = F.col(kind)
        self.note = F.col(note)
        self.uso = F.col(uso)

    def _other(self) -> Column:
        return self.kind.ilike(self.v.other)

    def cr(self) -> Column:
        return self.kind.ilike(self.v.cr) | (self._other() & self.note.like(self.v.note_cr))

    def arq(self) -> Column:
        return self.kind.ilike(self.v.arq) | (self._other() & ~self.note.like(self.v.note_cr))

    def arm(self) -> Column:
        return self.kind.ilike(self.v.arm)

    def pole(self) -> Column:
        return self.kind.ilike(self.v.pole)

    def canal(self) -> Column:
        return self.kind.ilike(self.v.canal) | self.kind.isNull()

    def cr_in_use(self) -> Column:
        return self.cr() & (self.uso != F.lit(self.v.uso_zero))

    def cr_unused(self) -> Column:
        return self.cr() & (self.uso == F.lit(self.v.uso_zero))

    def rest(self) -> Column:
        return ~(
            self.cr() | self.arq() | self.arm() | self.pole()
            | self.kind.ilike(self.v.canal) | self.kind.isNull()
        )
