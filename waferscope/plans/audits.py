"""Contract audits: what a database would refuse on insert, counted.

Audits walk the contract, not the tables they are given: a table, key or required column that is not there is
reported, never passed over. Keys and links are all answered from one scan of each table and one shuffle without a join: each
row gives an entry with the hashed key for each question, a link's entries meet those of the key it points at, and entries are
counted per key before they are moved, so a key that holds a large part of a table leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType

from waferscope.operators.cohort import Tables
from waferscope.sources.contract import TABLES, Field, Rule, Table
from waferscope.sources.inline import inline_rows

# Status words that reports are read by.
PASS, CHECK = "PASS", "**CHECK**"


@dataclass(frozen=True)
class Question:
    """Are these columns unique, or, with a parent, do they all point at one?"""

    number: int
    table: str
    columns: tuple[str, ...]
    primary: bool = False
    parent: str | None = None

    @property
    def text(self) -> str:
        return ", ".join(self.columns)

    def can_be_asked(self, tables: Tables) -> bool:
        there = self.table in tables and set(self.columns) <= set(tables[self.table].columns)
        return there and (not self.parent or self.parent in tables and TABLES[self.parent].key in tables[self.parent].columns)


def _all_questions() -> list[Question]:
    keys = [(t.name, (t.key,), True, None) for t in TABLES.values()]
    unique = [(t.name, columns, False, None) for t in TABLES.values() for columns in t.unique]
    links = [(t.name, (link.column,), False, link.parent) for t in TABLES.values() for link in t.links]
    return [Question(number, *rest) for number, rest in enumerate([*keys, *unique, *links])]


QUESTIONS = _all_questions()


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _spark(tables: Tables) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def _key_of(table: str) -> Question:
    return next(q for q in QUESTIONS if q.primary and q.table == table)


def _place(question: Question) -> tuple[int, int]:
    """Where a question's entries are counted: a key in a space of its own, a link in its parent's, in a slot from 1."""
    if not question.parent:
        return question.number, 0
    same = [q for q in QUESTIONS if q.parent == question.parent]
    return _key_of(question.parent).number, 1 + same.index(question)


SLOTS = 1 + max(_place(q)[1] for q in QUESTIONS)


# How a whole number is written as text, in one way only.
_WHOLE_NUMBER = "^(0|-?[1-9][0-9]{0,18})$"


def _numbers(df: DataFrame) -> set[str]:
    """The columns that hold whole numbers by their type."""
    return {f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)}


def _entry(space: int, slot: int, columns: tuple[str, ...], numbers: set[str], found: Column | int = 0) -> Column:
    """An entry for one row: the key as it is if its text is that of a whole number, else as two hashes of the text, 96 bits; NULL
    where a part of it is missing."""
    texts = [F.col(c).cast("string") for c in columns]
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))
    key, more = F.xxhash64(*texts, F.lit(0)), F.hash(F.lit(1), *texts)
    if len(columns) == 1 and columns[0] in numbers:
        key, more = F.col(columns[0]).cast("bigint"), F.lit(0)
    elif len(columns) == 1:
        number = F.when(texts[0].rlike(_WHOLE_NUMBER), texts[0].try_cast("bigint"))
        key, more = F.coalesce(number, key), F.when(number.isNotNull(), 0).otherwise(more)
    return F.struct(
        F.lit(space).alias("space"),
        F.lit(slot).alias("slot"),
        F.when(whole, key).alias("key"),
        F.when(whole, more).alias("more"),
        (found if isinstance(found, Column) else F.lit(found)).cast("long").alias("found"),
    )


def held_per_key(entries: DataFrame) -> DataFrame:
    """Entries counted per key and slot, ``held0`` for the key's own rows and the others for the links that point at it."""
    slots = [F.count(F.when(F.col("slot") == i, F.lit(1))).alias(f"held{i}") for i in range(SLOTS)]
    return entries.groupBy("space", "key", "more").agg(*slots, F.sum("found").alias("found"))


def bad_of(held: Callable[[int], Column]) -> list[Column]:
    """For each slot the bad rows of a key that holds so many in each: surplus or incomplete ones, and links without a parent."""
    surplus = F.when(F.col("key").isNull(), held(0)).otherwise(F.greatest(held(0) - 1, F.lit(0)))
    return [surplus] + [F.when((held(0) == 0) & F.col("key").isNotNull(), held(i)) for i in range(1, SLOTS)]


def entries_of(tables: Tables) -> DataFrame | None:
    """An entry for each row and question of the tables that are there; links without regard to their parent's table."""
    parts = []
    for table in TABLES.values():
        if table.name in tables:
            there = set(tables[table.name].columns)
            entries = [_entry(*_place(q), q.columns, _numbers(tables[table.name])) for q in QUESTIONS if q.table == table.name and set(q.columns) <= there]
            if entries:
                parts.append(tables[table.name].select(F.inline(F.array(*entries))))
    return _union(parts) if parts else None


def place_of(question: Question) -> tuple[int, int]:
    return _place(question)


def _answers(tables: Tables, asked: list[Question], rows_of: Sequence[Table] = ()) -> DataFrame:
    """``question, held, bad``: for keys the rows that are surplus or incomplete, for links the rows without a parent. The
    rows of a table and what is wrong within them are a question too, numbered below zero."""
    scanned = {q.number: q for q in [*asked, *[_key_of(q.parent) for q in asked if q.parent]]}.values()
    parts = []
    for number, table in enumerate(TABLES.values()):
        entries = [_entry(*_place(q), q.columns, _numbers(tables[table.name])) for q in scanned if q.table == table.name]
        if table in rows_of:
            entries.append(_entry(-1 - number, 0, (), set(), _wrong_in_row(tables, table)))
        if entries:
            parts.append(tables[table.name].select(F.inline(F.array(*entries))))
    per_key = held_per_key(_union(parts))
    bad = bad_of(lambda slot: F.col(f"held{slot}"))
    bad[0] = F.when(F.col("space") < 0, F.col("found")).otherwise(bad[0])
    sums = [F.struct(F.lit(i).alias("slot"), F.sum(f"held{i}").alias("held"), F.sum(bad[i]).alias("bad")) for i in range(SLOTS)]
    per_slot = per_key.groupBy("space").agg(F.array(*sums).alias("sums")).select("space", F.inline("sums"))
    places = [(*_place(q), q.number) for q in asked] + [(-1 - n, 0, -1 - n) for n, t in enumerate(TABLES.values()) if t in rows_of]
    named = inline_rows(_spark(tables), "space int, slot int, question int", places)
    return per_slot.join(named, ["space", "slot"]).select("question", "held", F.coalesce("bad", F.lit(0).cast("long")).alias("bad"))


def _reported(tables: Tables, wanted: list[Question]) -> DataFrame:
    """``question, bad`` for every question wanted; NULL where it could not be asked."""
    asked = [q for q in wanted if q.can_be_asked(tables)]
    listed = inline_rows(
        _spark(tables),
        "question int, asked boolean, table_name string, key string, parent_table string",
        [(q.number, q in asked, q.table, q.text, q.parent) for q in wanted],
    )
    if not asked:
        return listed.withColumn("bad", F.lit(None).cast("long"))
    answers = _answers(tables, asked).select("question", "bad")
    found = F.when(F.col("asked"), F.coalesce("bad", F.lit(0).cast("long")))
    return listed.join(answers, "question", "left").withColumn("bad", found)


def _key_audit(tables: Tables, wanted: list[Question]) -> DataFrame:
    return _reported(tables, wanted).select("table_name", "key", F.col("bad").alias("bad_rows"))


def pk_audit(tables: Tables) -> DataFrame:
    """Rows that are surplus for their primary key or lack it; NULL where the table or its key is absent."""
    return _key_audit(tables, [q for q in QUESTIONS if q.primary])


def unique_audit(tables: Tables) -> DataFrame:
    """Rows that are surplus for a unique key or lack part of it; NULL where the table or a column is absent."""
    return _key_audit(tables, [q for q in QUESTIONS if not q.primary and not q.parent])


def fk_audit(tables: Tables) -> DataFrame:
    """Rows whose link points at no parent. A NULL link passes; NULL where either table or the column is absent."""
    return _reported(tables, [q for q in QUESTIONS if q.parent]).select(
        F.concat_ws(".", "table_name", "key").alias("fk_name"),
        F.col("table_name").alias("child_table"),
        "parent_table",
        F.col("bad").alias("orphans"),
    )


def _breaks(rule: Rule) -> Column:
    """Whether a row breaks a value rule; a rule that comes out NULL passes."""
    return F.coalesce(~F.expr(rule.holds), F.lit(False))


def _is_null(f: Field) -> Column:
    return F.col(f.name).isNull() if f.required else F.lit(False)


def _is_too_long(f: Field) -> Column:
    return F.coalesce(F.length(f.name) > f.max_length, F.lit(False)) if f.max_length else F.lit(False)


def _watched(tables: Tables, table: Table) -> list[Field]:
    present = set(tables[table.name].columns)
    return [f for f in table.fields if f.name in present and (f.required or f.max_length)]


def _absent(tables: Tables, table: Table) -> list[str]:
    """The required columns that a table lacks."""
    present = set(tables[table.name].columns) if table.name in tables else set()
    return [f.name for f in table.fields if f.required and f.name not in present]


def _rules(tables: Tables, table: Table) -> list[Rule]:
    """The rules of a table that has the columns they speak of."""
    names = {f.name for f in table.fields} - set(tables[table.name].columns)
    return [rule for rule in table.rules if not any(name in rule.holds.split() for name in names)]


def _wrong_in_row(tables: Tables, table: Table) -> Column:
    """How many values of a row are missing, too long or against a rule."""
    faults = [check(f) for f in _watched(tables, table) for check in (_is_null, _is_too_long)]
    faults += [_breaks(rule) for rule in _rules(tables, table)]
    return reduce(lambda a, b: a + b, [fault.cast("int") for fault in faults], F.lit(0))


def check_audit(tables: Tables) -> DataFrame:
    """Rows that break a value rule; NULL where the table or a column of the rule is absent."""

    def one(table: Table, rule: Rule) -> DataFrame:
        names = [F.lit(rule.name).alias("check_name"), F.lit(table.name).alias("table_name")]
        if table.name not in tables or rule not in _rules(tables, table):
            return inline_rows(_spark(tables), "violations bigint", [(None,)]).select(*names, "violations")
        broken = F.count(F.when(_breaks(rule), F.lit(1)))
        return tables[table.name].agg(broken.alias("violations")).select(*names, "violations")

    return _union([one(table, rule) for table in TABLES.values() for rule in table.rules])


def not_null_audit(tables: Tables) -> DataFrame:
    """Missing values in required columns and texts longer than declared, in one scan per table.

    A required column that is not there has ``present`` false and no counts.
    """

    def one(table: Table) -> list[DataFrame]:
        absent = [(table.name, name, False, None, None) for name in _absent(tables, table)]
        schema = "table_name string, column string, present boolean, nulls bigint, too_long bigint"
        parts = [inline_rows(_spark(tables), schema, absent)] if absent else []
        if table.name in tables:
            counts = [
                F.struct(
                    F.lit(f.name).alias("column"),
                    F.lit(True).alias("present"),
                    F.count(F.when(_is_null(f), F.lit(1))).alias("nulls"),
                    F.count(F.when(_is_too_long(f), F.lit(1))).alias("too_long"),
                )
                for f in _watched(tables, table)
            ]
            scanned = tables[table.name].agg(F.array(*counts).alias("found"))
            parts.append(scanned.select(F.lit(table.name).alias("table_name"), F.inline("found")))
        return parts

    return _union([part for table in TABLES.values() for part in one(table)])


def contract_links(tables: Tables) -> DataFrame:
    """Every declared link, child to parent, and how many rows use it; NULL where the child or the column is absent."""

    def one(table: Table) -> DataFrame:
        present = set(tables[table.name].columns) if table.name in tables else set()
        counts = [
            F.struct(
                F.lit(f"{table.name}.{link.column}").alias("fk_name"),
                F.lit(link.parent).alias("parent_table"),
                (F.count(link.column) if link.column in present else F.lit(None).cast("long")).alias("rows"),
            )
            for link in table.links
        ]
        scanned = (tables[table.name] if present else _spark(tables).range(0)).agg(F.array(*counts).alias("found"))
        return scanned.select(F.lit(table.name).alias("child_table"), F.inline("found"))

    return _union([one(table) for table in TABLES.values() if table.links]).select(
        "fk_name", "child_table", "parent_table", "rows"
    )


def contract_summary(tables: Tables) -> DataFrame:
    """Tables that are there, declared links between them, rows, violations and a verdict, per table and in a last row.

    An absent table or required column is a violation; a table's rows are then NULL. The last row passes only with all
    tables and links of the contract and no violation. Each table is scanned once.
    """
    present = [table for table in TABLES.values() if table.name in tables]
    asked = [q for q in QUESTIONS if q.can_be_asked(tables)]
    answers = _answers(tables, asked, present)
    owners = [(q.number, q.table, False) for q in asked]
    owners += [(-1 - place, table.name, True) for place, table in enumerate(TABLES.values())]
    owner = inline_rows(_spark(tables), "question int, table_name string, is_rows boolean", owners)
    found = (
        answers.join(owner, "question")
        .groupBy("table_name")
        .agg(F.sum(F.when(F.col("is_rows"), F.col("held"))).alias("rows"), F.sum("bad").alias("bad"))
    )
    declared = inline_rows(
        _spark(tables),
        "table_name string, tables bigint, links bigint, missing bigint",
        [
            (
                table.name,
                int(table in present),
                sum(q.table == table.name and q.parent is not None for q in asked),
                len(_absent(tables, table)) if table in present else 1,
            )
            for table in TABLES.values()
        ],
    )
    is_there = F.col("tables") == 1
    per_table = declared.join(found, "table_name", "left").select(
        "table_name",
        "tables",
        "links",
        F.when(is_there, F.coalesce("rows", F.lit(0).cast("long"))).alias("rows"),
        (F.col("missing") + F.coalesce("bad", F.lit(0))).alias("violations"),
    )
    sums = [F.sum(column).alias(column) for column in ("tables", "links", "rows", "violations")]
    totals = per_table.agg(*sums).select(F.lit("(all)").alias("table_name"), "*")
    links = sum(len(table.links) for table in TABLES.values())
    complete = (F.col("tables") == len(TABLES)) & (F.col("links") == links)
    status = F.when((F.col("violations") == 0) & ((F.col("table_name") != "(all)") | complete), PASS).otherwise(CHECK)
    return per_table.unionByName(totals).withColumn("status", status)
