"""Query tables: every query is a set of rows in a ``clauses`` DataFrame.

``clauses(qid, clause_id, parent_id, depth, modifier, kind, field, text, boost)``

* ``parent_id`` 0 is the implicit root of each query; top-level clauses have depth 1.
* ``kind``: bool | phrase | phrase_prefix | term_prefix | term | every_term | one_of | all
* ``modifier``: must | should | must_not

Builders here turn tables of query text into clause rows with column expressions only
(``explode`` of array literals, never a join against the corpus).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stored

# Query types and modifiers, in their numeric order.
KINDS = ("bool", "phrase", "phrase_prefix", "term_prefix", "term", "every_term", "one_of", "all")
MODIFIERS = ("must", "should", "must_not")
LEAF_KINDS = KINDS[1:]

CLAUSE_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()),
    T.StructField("clause_id", T.IntegerType()),
    T.StructField("parent_id", T.IntegerType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("modifier", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("boost", T.DoubleType()),
])

# The preset relevance recipe (P15): (kind, field role, boost).
RECIPE = (
    ("phrase_prefix", "title", 20.0), ("phrase", "title", 20.0), ("every_term", "title", 0.75),
    ("one_of", "title", 0.5), ("phrase_prefix", "body", 1.0), ("phrase", "body", 1.0),
    ("every_term", "body", 0.5), ("one_of", "body", 0.25),
)


def clause_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Small hand-written query trees (tests, examples)."""
    return spark.createDataFrame(rows, CLAUSE_SCHEMA)


def leaf(qid: int, clause_id: int, modifier: str, kind: str, field: str | None, text: str | None,
         boost: float = 1.0, parent_id: int = 0, depth: int = 1) -> tuple:
    return (qid, clause_id, parent_id, depth, modifier, kind, field, text, float(boost))


def group(qid: int, clause_id: int, modifier: str, boost: float = 1.0, parent_id: int = 0,
          depth: int = 1) -> tuple:
    return (qid, clause_id, parent_id, depth, modifier, "bool", None, None, float(boost))


def escape_reserved(text: Column) -> Column:
    """P13: ':' and '?' become spaces before keyword search."""
    return F.translate(text, ":?", "  ")


def single_clause(queries: DataFrame, kind: str, field: str, modifier: str = "should",
                  boost: float = 1.0, qid: str = "qid", text: str = "text") -> DataFrame:
    """One leaf per query row."""
    return queries.select(
        F.col(qid).cast("long").alias("qid"), F.lit(1).alias("clause_id"), F.lit(0).alias("parent_id"),
        F.lit(1).alias("depth"), F.lit(modifier).alias("modifier"), F.lit(kind).alias("kind"),
        F.lit(field).alias("field"), F.col(text).alias("text"), F.lit(float(boost)).alias("boost"))


def recipe_clauses(queries: DataFrame, title_field: str, body_field: str, qid: str = "qid",
                   text: str = "text") -> DataFrame:
    """Eight Should clauses per query (no join: an array literal exploded per row)."""
    role = {"title": title_field, "body": body_field}
    recipe = F.array(*[F.struct(F.lit(i + 1).alias("cid"), F.lit(k).alias("kind"), F.lit(role[r]).alias("field"),
                                F.lit(b).alias("boost")) for i, (k, r, b) in enumerate(RECIPE)])
    return (queries.select(F.col(qid).cast("long").alias("qid"), F.col(text).alias("text"),
                           F.explode(recipe).alias("r"))
            .select("qid", F.col("r.cid").alias("clause_id"), F.lit(0).alias("parent_id"),
                    F.lit(1).alias("depth"), F.lit("should").alias("modifier"), F.col("r.kind").alias("kind"),
                    F.col("r.field").alias("field"), "text", F.col("r.boost").alias("boost")))


_WORD_OR_PHRASE = r'"[^"]*"|[^\s"]+'


def keyword_clauses(queries: DataFrame, field_weights: dict[str, float], operator: str = "or",
                    qid: str = "qid", text: str = "text", escape: bool = False) -> DataFrame:
    """Whitespace words (or quoted phrases) x weighted fields.

    Each word is a group (Should for ``or``, Must for ``and``) holding one phrase leaf per
    field boosted by the field weight; a standalone ``OR`` is the default operator and is
    dropped; an ``AND`` makes the words on both sides Must. A word that analyzes to several tokens in a positional field is a phrase.
    """
    if not field_weights:
        raise ValueError("fieldNames must not be empty")
    if operator not in ("or", "and"):
        raise ValueError("operator must be 'or' or 'and'")
    t = F.col(text)
    if escape:
        t = escape_reserved(t)
    words = F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(_WORD_OR_PHRASE), 0)
    # the words around a standalone AND are both required, whatever the default operator
    joined = lambda i: F.coalesce(F.get("ws", i) == "AND", F.lit(False))
    must = F.lit(operator == "and") | joined(F.col("wi") - 1) | joined(F.col("wi") + 1)
    fw = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(float(w)).alias("w")) for f, w in field_weights.items()])
    nf = len(field_weights)
    base = (queries.select(F.col(qid).cast("long").alias("qid"), words.alias("ws"))
            .select("qid", "ws", F.posexplode("ws").alias("wi", "word"))
            .filter(~F.col("word").isin("OR", "AND")).select("qid", "wi", "word", must.alias("must")))
    groups = base.select(
        "qid", (F.col("wi") * (nf + 1) + 1).cast("int").alias("clause_id"), F.lit(0).alias("parent_id"),
        F.lit(1).alias("depth"), F.when(F.col("must"), F.lit("must")).otherwise(F.lit("should")).alias("modifier"),
        F.lit("bool").alias("kind"), F.lit(None).cast("string").alias("field"),
        F.lit(None).cast("string").alias("text"), F.lit(1.0).alias("boost"))
    leaves = base.select("qid", "wi", "word", F.posexplode(fw).alias("fi", "fw")).select(
        "qid", (F.col("wi") * (nf + 1) + 2 + F.col("fi")).cast("int").alias("clause_id"),
        (F.col("wi") * (nf + 1) + 1).cast("int").alias("parent_id"), F.lit(2).alias("depth"),
        F.lit("should").alias("modifier"), F.lit("phrase").alias("kind"), F.col("fw.f").alias("field"),
        F.regexp_replace("word", '"', "").alias("text"), F.col("fw.w").alias("boost"))
    return groups.unionByName(leaves)


# --- P14: saved query specs (JSON) ----------------------------------------------------

#: A saved query is JSON whose arrays and objects are nested at most this deep (about 41 groups).
MAX_JSON_DEPTH = 127
#: Levels of the trees that one job walks down.
LEVELS = 8


def json_depth(text: Column) -> Column:
    """How deep arrays and objects are nested in a JSON text."""
    plain = F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "")
    marks = F.filter(F.split(F.regexp_replace(plain, r"[^\[\]{}]", ""), ""), lambda c: c != "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc, c):
        now = acc["now"] + F.when(c.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(marks, start, step, lambda acc: acc["most"])


def parse_specs(specs: DataFrame, column: str = "spec_json") -> DataFrame:
    """``specs`` with ``spec``, the parsed JSON as a variant (null if it is no JSON), and ``too_deep``: a text
    nested deeper than MAX_JSON_DEPTH is not parsed but marked, never cut."""
    deep = F.coalesce(json_depth(F.col(column)) > MAX_JSON_DEPTH, F.lit(False))
    return (specs.withColumn("too_deep", deep)
            .withColumn("spec", F.try_parse_json(F.when(~F.col("too_deep"), F.col(column)))))


def _part(c: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(c, path, kind)


def _number(c: Column, path: str, kind: str) -> Column:
    """A number of a clause; null if there is none or something else."""
    found = F.schema_of_variant(_part(c, path, "variant"))
    return F.when((found == "BIGINT") if kind == "int" else found.rlike("^(BIGINT|DOUBLE|DECIMAL)"), _part(c, path, kind))


def _walk(base: DataFrame) -> DataFrame:
    """(qid, path, c): every clause of the trees of ``base`` (qid, subs), at its element index path.

    The clauses that are not walked yet form a stored frontier table; a job takes it LEVELS levels
    further down. A step turns each of its clauses into itself, done, and its subclauses, in one pass:
    no branch is evaluated twice, and the plan does not grow with the depth of the trees."""
    empty = F.array().cast("array<struct<path:array<int>,c:variant,done:boolean>>")

    def below(subs: Column, path: Column) -> Column:
        return F.transform(F.coalesce(subs, F.array().cast("array<variant>")), lambda c, i: F.struct(
            F.concat(path, F.array(i.cast("int"))).alias("path"), c.alias("c"), F.lit(False).alias("done")))

    now = base.select("qid", F.explode(below(F.col("subs"), F.array().cast("array<int>"))).alias("x")).select("qid", "x.*")
    out = None
    while True:
        for _ in range(LEVELS):
            group = F.coalesce(_number(F.col("c"), "$.query_type", "int") == 0, F.lit(False)) & ~F.col("done")
            subs = below(_part(F.col("c"), "$.query.subqueries", "array<variant>"), F.col("path"))
            self_ = F.array(F.struct("path", "c", F.lit(True).alias("done")))
            now = now.select("qid", F.explode(F.concat(self_, F.when(group, subs).otherwise(empty))).alias("x")).select("qid", "x.*")
        now = stored(now, "clauses")
        done = now.filter("done").select("qid", "path", "c")
        out = done if out is None else out.unionByName(done)
        now = now.filter("NOT done")
        if now.limit(1).count() == 0:
            return out


def flatten_specs(specs: DataFrame, qid: str = "qid", spec: str = "spec") -> DataFrame:
    """Flatten parsed specs (column ``spec``, see ``parse_specs``) into clause rows.

    Missing leaf boost -> 1.0, missing index -> 0, root boost ignored. Clause ids number the
    clauses of a query in depth-first order of their element index paths. A clause that can't be
    converted keeps its row, with an ``error`` for ``query_rejects``.
    """
    s = F.col(spec)
    base = stored(specs.select(
        F.col(qid).cast("long").alias("qid"), _part(s, "$.texts", "array<string>").alias("texts"),
        _part(s, "$.fields", "array<string>").alias("fields"), _part(s, "$.query.subqueries", "array<variant>").alias("subs")), "specs")
    cur = _walk(base).join(base.select("qid", "texts", "fields"), "qid")
    c = F.col("c")
    cur = cur.select("qid", "path", "texts", "fields", _number(c, "$.query_type", "int").alias("kind_idx"),
                     _number(c, "$.query_modifier", "int").alias("mod_idx"), _number(c, "$.query.boost", "double").alias("q_boost"),
                     F.coalesce(_number(c, "$.query.field_index", "int"), F.lit(0)).alias("fi"),
                     F.coalesce(_number(c, "$.query.text_index", "int"), F.lit(0)).alias("ti"),
                     _part(c, "$.query.subqueries", "array<variant>").isNull().alias("no_subs"),
                     F.coalesce(F.schema_of_variant(_part(c, "$.query", "variant")).startswith("OBJECT"), F.lit(False)).alias("has_query"))
    kind_idx, mod_idx, fi, ti = (F.col(x) for x in ("kind_idx", "mod_idx", "fi", "ti"))
    kind = F.get(F.array(*[F.lit(k) for k in KINDS]), kind_idx)
    mod = F.get(F.array(*[F.lit(m) for m in MODIFIERS]), mod_idx)
    is_leaf = F.coalesce(kind_idx.between(1, 6), F.lit(False))
    is_group = F.coalesce(kind_idx == 0, F.lit(False))
    n_fields, n_texts = (F.coalesce(F.size(x), F.lit(0)) for x in ("fields", "texts"))
    err = (F.when(mod_idx.isNull(), F.lit("missing field `query_modifier`"))
           .when(~mod_idx.between(0, 2), F.lit("Invalid query_modifier"))
           .when(kind_idx.isNull(), F.lit("missing field `query_type`"))
           .when(~kind_idx.between(0, 7), F.lit("Invalid query_type"))
           .when(is_group & F.col("no_subs"), F.lit("missing field `subqueries`"))
           .when(is_group & F.col("q_boost").isNull(), F.lit("missing field `boost`"))
           .when(~F.col("has_query"), F.lit("missing field `query`"))
           .when(is_leaf & ((fi < 0) | (fi >= n_fields)), F.lit("Invalid field index"))
           .when(is_leaf & ((ti < 0) | (ti >= n_texts)), F.lit("Invalid text index")))
    out = cur.select(
        "qid", F.size("path").alias("depth"), mod.alias("modifier"), kind.alias("kind"),
        F.when(is_leaf, F.get(F.col("fields"), fi)).alias("field"), F.when(is_leaf, F.get(F.col("texts"), ti)).alias("text"),
        F.coalesce("q_boost", F.lit(1.0)).alias("boost"), err.alias("error"), "path",
        F.slice("path", F.lit(1), F.size("path") - 1).alias("ppath"), n_fields.alias("n_fields"), n_texts.alias("n_texts"))
    # a query's clauses fit a row: they come from one JSON text. The root's path is empty: parent 0
    paths = F.sort_array(F.collect_list("path").over(Window.partitionBy("qid")))
    return (out.withColumn("_paths", paths)
            .withColumn("clause_id", F.array_position("_paths", F.col("path")).cast("int"))
            .withColumn("parent_id", F.array_position("_paths", F.col("ppath")).cast("int"))
            .select("qid", "clause_id", "parent_id", "depth", "modifier", "kind", "field", "text", "boost", "error",
                    "path", "n_fields", "n_texts"))


def spec_json_from_text(queries: DataFrame, fields: list[str], qid: str = "qid", text: str = "text") -> DataFrame:
    """Builds a saved spec per query row: the recipe tree as JSON (texts/fields interned)."""
    fidx = {f: i for i, f in enumerate(fields)}
    subs = []
    for k, role, b in RECIPE:
        f = fields[0] if role == "title" else fields[-1]
        subs.append(F.struct(
            F.struct(F.lit(fidx[f]).alias("field_index"), F.lit(0).alias("text_index"), F.lit(b).alias("boost")).alias("query"),
            F.lit(1).alias("query_modifier"), F.lit(KINDS.index(k)).alias("query_type")))
    spec = F.struct(F.array(F.col(text)).alias("texts"), F.array(*[F.lit(f) for f in fields]).alias("fields"),
                    F.struct(F.array(*subs).alias("subqueries"), F.lit(1.0).alias("boost")).alias("query"))
    return queries.select(F.col(qid).cast("long").alias("qid"), F.to_json(spec).alias("spec_json"))
