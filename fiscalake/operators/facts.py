"""Gold facts.

Every dimension key is a hash of the row's own columns, and every dimension is built
from the same Silver rows. A foreign key can therefore be computed in place: the
inner joins of the model can only drop rows whose key is NULL. Without dimensions
the facts take that join-free path; given dimensions they join them, which also
drops rows a dimension does not know.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fiscalake.functions.keys import (
    MISSING_MEMBER_KEY,
    hash_key,
    or_missing_member,
    organisation_hash,
    period_key,
    subclass_hash,
)
from fiscalake.operators.dimensions import with_supplier_key
from fiscalake.operators.occurrences import COPIES_PER_TASK, number_copies


@dataclass(frozen=True)
class ExpenseDimensions:
    municipality: DataFrame
    organisation: DataFrame
    supplier: DataFrame


@dataclass(frozen=True)
class RevenueDimensions:
    municipality: DataFrame
    organisation: DataFrame
    source: DataFrame
    application: DataFrame
    class_: DataFrame
    subclass: DataFrame


def expense_fingerprint() -> Column:
    """Content hash; the source path stays out, so re-extraction keeps the key."""
    return hash_key(
        *[
            F.col(name)
            for name in (
                "municipio",
                "exercicio",
                "mes",
                "orgao",
                "evento",
                "nr_empenho",
                "id_fornecedor",
                "nm_fornecedor",
                "dt_emissao_despesa",
                "vl_despesa",
            )
        ]
    )


def _all_present(*names: str) -> Column:
    present = F.col(names[0]).isNotNull()
    for name in names[1:]:
        present = present & F.col(name).isNotNull()
    return present


def _join_places(tuples: DataFrame, municipality: DataFrame, organisation: DataFrame) -> DataFrame:
    members = organisation.select("municipio", F.col("nm_orgao").alias("orgao"), "orgao_sk")
    return tuples.join(municipality.select("municipio", "municipio_sk"), "municipio").join(
        members, ["municipio", "orgao"]
    )


def _join_through_tuples(
    rows: DataFrame, names: Sequence[str], with_keys: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``rows`` with the keys that ``with_keys`` adds to their distinct ``names``.

    Few municipalities and organisations hold most rows. The dimensions therefore meet
    distinct tuples only, and rows move once, by the whole tuple.
    """
    keyed = with_keys(rows.select(*names).distinct())
    keys = [c for c in keyed.columns if c not in names]
    keyed = keyed.select(*[F.col(n).alias(f"_{n}") for n in names], *keys)
    same = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names])
    return rows.join(keyed, same).drop(*[f"_{n}" for n in names])


def _with_expense_keys(rows: DataFrame, dims: ExpenseDimensions | None) -> DataFrame:
    if dims is None:
        return rows.where(_all_present("municipio", "orgao", "fornecedor_bk")).withColumns(
            {
                "municipio_sk": hash_key(F.col("municipio")),
                "orgao_sk": organisation_hash(F.col("municipio"), F.col("orgao")),
                "fornecedor_sk": hash_key(F.col("fornecedor_bk")),
            }
        )
    suppliers = dims.supplier.select("fornecedor_bk", "fornecedor_sk")
    return _join_through_tuples(
        rows,
        ("municipio", "orgao", "fornecedor_bk"),
        lambda tuples: _join_places(tuples, dims.municipality, dims.organisation).join(
            suppliers, "fornecedor_bk"
        ),
    )


def fct_expense(
    silver: DataFrame, dims: ExpenseDimensions | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per expense event; shuffle-free unless dimensions have to be joined.

    Further Silver columns in ``keep`` stay beside the fact's own.
    """
    return _with_expense_keys(with_supplier_key(silver), dims).select(
        expense_fingerprint().alias("despesa_sk"),
        "municipio_sk",
        "orgao_sk",
        period_key(F.col("exercicio"), F.col("mes")).alias("tempo_sk"),
        "fornecedor_sk",
        "exercicio",
        "mes",
        "evento",
        "nr_empenho",
        "dt_emissao_despesa",
        "vl_despesa",
        "id_fornecedor",
        F.col("nm_fornecedor").alias("nm_fornecedor_origem"),
        *keep,
    )


_REVENUE_FINGERPRINT = (
    "municipio_sk",
    "orgao_sk",
    "tempo_sk",
    "fonte_recurso_sk",
    "aplicacao_sk",
    "alinea_sk",
    "subalinea_sk",
    "vl_arrecadacao",
)

_REVENUE_TEXTS = ("ds_fonte_recurso", "ds_cd_aplicacao_fixo", "ds_alinea")

_REVENUE_CONTENT = (
    "municipio",
    "exercicio",
    "mes",
    "orgao",
    "ds_fonte_recurso",
    "ds_cd_aplicacao_fixo",
    "ds_alinea",
    "ds_subalinea",
    "vl_arrecadacao",
)


def _with_revenue_keys(rows: DataFrame, dims: RevenueDimensions | None) -> DataFrame:
    texts, keys = _REVENUE_TEXTS, ("fonte_recurso_sk", "aplicacao_sk", "alinea_sk")
    if dims is None:
        return rows.where("complete").withColumns(
            {
                "municipio_sk": hash_key(F.col("municipio")),
                "orgao_sk": organisation_hash(F.col("municipio"), F.col("orgao")),
                **{key: hash_key(F.col(text)) for key, text in zip(keys, texts)},
                "subalinea_sk": or_missing_member(subclass_hash(F.col("ds_subalinea"))),
            }
        )
    # The special member is no join partner: a source text equal to its label must
    # not multiply rows.
    regular = dims.subclass.where(~F.col("is_nao_informada")).select("ds_subalinea", "subalinea_sk")

    def with_keys(tuples: DataFrame) -> DataFrame:
        joined = _join_places(tuples, dims.municipality, dims.organisation)
        for dim, text, key in zip((dims.source, dims.application, dims.class_), texts, keys):
            joined = joined.join(dim.select(text, key), text)
        return joined.join(regular, "ds_subalinea", "left").withColumn(
            "subalinea_sk", or_missing_member(F.col("subalinea_sk"))
        )

    return _join_through_tuples(rows, ("municipio", "orgao", *texts, "ds_subalinea"), with_keys)


def _keyed_contents(
    rows: DataFrame, dims: RevenueDimensions | None, keep: Sequence[str] = ()
) -> DataFrame:
    """Distinct revenue contents with row count, keys and fingerprint.

    Keys are hashed or joined per content: copies cost nothing. ``shared`` marks contents
    that may have their fingerprint in common: a missing year or month makes the period key
    NULL, and a dimension that does not know a subclass gives different texts one member.
    Columns in ``keep`` tell contents apart as well.
    """
    counted = rows.groupBy(*_REVENUE_CONTENT, *keep).agg(
        F.count(F.lit(1)).alias("copies"),
        # Aggregated, although these judge grouping columns: a filter on the columns
        # themselves would move below the shuffle, where it would split the shuffle in
        # two and repeat the parsing of columns that are not stored yet.
        F.max(F.col("mes").isNull() | F.col("exercicio").isNull()).alias("shared"),
        F.max(_all_present("municipio", "orgao", *_REVENUE_TEXTS)).alias("complete"),
    )
    keyed = _with_revenue_keys(counted, dims).drop("complete")
    if dims is not None:
        no_member = F.col("subalinea_sk") == MISSING_MEMBER_KEY
        keyed = keyed.withColumn("shared", F.col("shared") | no_member)
    return (
        keyed.withColumn("tempo_sk", period_key(F.col("exercicio"), F.col("mes")))
        .withColumn(
            "receita_fingerprint", hash_key(*[F.col(name) for name in _REVENUE_FINGERPRINT])
        )
    )


_REVENUE_KEYS = (
    "municipio_sk",
    "orgao_sk",
    "tempo_sk",
    "fonte_recurso_sk",
    "aplicacao_sk",
    "alinea_sk",
    "subalinea_sk",
)

#: What a revenue occurrence says, as the fact stores it; with the fingerprint it is its content.
_OCCURRENCE = (
    "receita_fingerprint",
    *_REVENUE_KEYS,
    "exercicio",
    "mes",
    "vl_arrecadacao",
    "nm_orgao_origem",
    *_REVENUE_TEXTS,
    "ds_subalinea",
)


def _as_occurrences(numbered: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return numbered.select(
        hash_key(F.col("receita_fingerprint"), F.col("nr_ocorrencia")).alias("receita_sk"),
        "receita_fingerprint",
        "nr_ocorrencia",
        *_OCCURRENCE[1:],
        *keep,
    )


def fct_revenue(
    silver: DataFrame,
    dims: RevenueDimensions | None = None,
    copies_per_task: int = COPIES_PER_TASK,
) -> DataFrame:
    """One row per revenue occurrence; identical ones are kept and numbered.

    The one shuffle moves distinct contents and their counts, not rows.

    Contents with one fingerprint are numbered one after the other, by year, month and
    subclass text, so that no key occurs twice.
    """
    numbered = number_copies(
        _keyed_contents(silver, dims),
        copies="copies",
        number="nr_ocorrencia",
        key="receita_fingerprint",
        shared="shared",
        order=("exercicio", "mes", "ds_subalinea"),
        copies_per_task=copies_per_task,
    )
    return _as_occurrences(numbered.withColumnRenamed("orgao", "nm_orgao_origem"))


def revenue_contents(silver: DataFrame, origin: str) -> DataFrame:
    """Counted revenue contents of each ``origin``, a column of ``silver``, with their fingerprint."""
    keyed = _keyed_contents(silver, None, (origin,)).withColumnRenamed("orgao", "nm_orgao_origem")
    return keyed.select(*_OCCURRENCE, origin, "copies")


def _counted(occurrences: DataFrame, origin: str) -> DataFrame:
    return occurrences.groupBy(*_OCCURRENCE, origin).agg(F.count(F.lit(1)).alias("copies"))


def changed_fingerprints(
    occurrences: DataFrame, contents: DataFrame, origins: Sequence[str], origin: str
) -> DataFrame:
    """Fingerprints of which ``origins`` have other rows in ``contents`` than in ``occurrences``."""
    replaced = occurrences.where(F.col(origin).isin(list(origins)))
    before = _counted(replaced, origin).withColumn("copies", -F.col("copies"))
    return (
        before.unionByName(contents)
        .groupBy(*_OCCURRENCE, origin)
        .agg(F.sum("copies").alias("copies"))
        .where(F.col("copies") != 0)
        .select("receita_fingerprint")
        .distinct()
    )


def revise_revenue(
    occurrences: DataFrame,
    contents: DataFrame,
    origins: Sequence[str],
    origin: str,
    copies_per_task: int = COPIES_PER_TASK,
    changed: DataFrame | None = None,
    near: Sequence[str] = (),
) -> DataFrame:
    """``occurrences`` with what ``origins`` said before replaced by ``contents``.

    ``occurrences`` are rows of the fact with their ``origin``, ``contents`` the counted new
    contents of ``origins``. Both sides are counted with opposite signs: where nothing is
    left, nothing has changed. Fingerprints with a difference are numbered anew over all their
    origins, all other rows stay as they are. Doing it again changes nothing.

    ``changed`` are the ``changed_fingerprints`` if they are stored already. Rows that are equal in
    the columns ``near`` come from few tasks.
    """
    if changed is None:
        changed = changed_fingerprints(occurrences, contents, origins, origin)
    counted = _counted(occurrences.where(~F.col(origin).isin(list(origins))), origin)
    touched = lambda df: df.join(changed, "receita_fingerprint", "left_semi")
    numbered = number_copies(
        touched(counted.unionByName(contents)).withColumn("shared", F.lit(True)),
        copies="copies",
        number="nr_ocorrencia",
        key="receita_fingerprint",
        shared="shared",
        order=("exercicio", "mes", "ds_subalinea", origin),
        copies_per_task=copies_per_task,
        near=near,
    )
    kept = occurrences.join(changed, "receita_fingerprint", "left_anti")
    if near:
        kept = kept.hint("rebalance", *near)
    return kept.unionByName(_as_occurrences(numbered, (origin,)))
