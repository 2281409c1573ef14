"""Field declarations (S4) and field copying."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import analyzers as A

RECORD_BASIC, RECORD_FREQS, RECORD_POSITIONS = 0, 1, 2


@dataclass(frozen=True)
class FieldSpec:
    name: str
    analyzer: str = "default"
    stored: bool = True
    fast: bool = False
    record: int = RECORD_POSITIONS
    is_text: bool = True  # accepted for parity; the analyzer applies either way


@dataclass
class Schema:
    """Fixed, ordered set of text fields plus the named analyzers they use."""

    fields: list[FieldSpec] = field(default_factory=list)
    analyzers: dict[str, A.Analyzer] = field(default_factory=lambda: {"default": A.default()})
    lexicons: dict[str, DataFrame] = field(default_factory=dict)  # analyzer name -> lexicon(word)
    stems: dict[str, DataFrame] = field(default_factory=dict)  # analyzer name -> stems(lang, term, stem)

    def add_text_field(self, name: str, stored: bool = True, is_text: bool = True, is_fast: bool = False,
                       record: int = RECORD_POSITIONS, analyzer: str = "default") -> "Schema":
        if any(f.name == name for f in self.fields):
            raise ValueError(f"field already defined: {name}")
        if record not in (RECORD_BASIC, RECORD_FREQS, RECORD_POSITIONS):
            raise ValueError("Invalid index_record_option_const")
        self.fields.append(FieldSpec(name, analyzer, stored, is_fast, record, is_text))
        return self

    def register(self, name: str, analyzer: A.Analyzer, lexicon: DataFrame | None = None,
                 stems: DataFrame | None = None) -> "Schema":
        """``stems`` (lang, term, stem) is the user's dictionary of a stemming analyzer; the index, query
        text, highlights and maintenance all use it."""
        from ..functions.stem import has_rules
        if analyzer.lang is not None and stems is None and not has_rules(analyzer.lang):
            raise ValueError(f"no stemming rules for {analyzer.lang}: give a dictionary")
        if analyzer.kind == "lexicon" and lexicon is None:
            raise ValueError("a lexicon analyzer needs a lexicon(word) DataFrame")
        self.analyzers[name] = analyzer
        if lexicon is not None:
            self.lexicons[name] = lexicon
        if stems is not None:
            self.stems[name] = stems
        return self

    def lexicon_of(self, name: str) -> DataFrame:
        return self.lexicons[self.field(name).analyzer]

    def stems_of(self, name: str) -> DataFrame | None:
        return self.stems.get(self.field(name).analyzer)

    def field(self, name: str) -> FieldSpec:
        for f in self.fields:
            if f.name == name:
                return f
        raise ValueError("field not found in schema")

    def analyzer_of(self, name: str) -> A.Analyzer:
        spec = self.field(name)
        if spec.analyzer not in self.analyzers:
            raise ValueError(f"unknown analyzer: {spec.analyzer}")
        return self.analyzers[spec.analyzer]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def stored(self) -> list[str]:
        return [f.name for f in self.fields if f.stored]

    @property
    def kept(self) -> list[str]:
        """Fields whose values are written with the documents: stored or fast."""
        return [f.name for f in self.fields if f.stored or f.fast]


def copy_to_fields(df: DataFrame, value_col: str, schema: Schema, *names: str) -> DataFrame:
    """Copy one value into several fields. A field that already holds values
    becomes multi-valued (array), keeping insertion order."""
    if not names:
        raise ValueError("field names is empty")
    for n in names:
        schema.field(n)
    out = df
    for n in names:
        v = F.array(F.col(value_col))
        if n in out.columns:
            out = out.withColumn(n, F.concat(_as_array(out, n), v))
        else:
            out = out.withColumn(n, v)
    return out


def _as_array(df: DataFrame, name: str):
    from pyspark.sql.types import ArrayType
    c = F.col(name)
    if isinstance(df.schema[name].dataType, ArrayType):
        return F.coalesce(c, F.array().cast("array<string>"))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c))
