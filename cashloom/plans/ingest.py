"""Purchase and sales ingest: from a feed to rejects, parties, addresses and invoices."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import is_valid_tax_id, normalize_term, strip_punctuation
from ..operators.dimensions import (
    assign_surrogate_keys,
    build_invoice_fact,
    changed_addresses,
    changed_members,
    ids_of_keys,
    latest_per_key,
    merge_upsert,
    new_addresses,
    new_members,
    one_id_per_key,
    resolve_party_address,
    unprocessed_distinct,
)
from ..operators.quality import (
    domain_membership,
    fill_defaults,
    first_failing_rule,
    split_valid_rejected,
    trim_cast_columns,
)
from ..presets import DEFAULT_NUMBER, DEFAULT_TEXT, FEED_CASTS, INVOICE_COLUMNS, PURCHASES, SALES, Layout, feed_rules
from ..sources.staging import shared_copy

ADDRESS_COLUMNS = ("ID_TIPO_ENDERECO", "NUMERO", "COMPLEMENTO")
ACCEPTED = "OK"
LOG_KEY = ("NUMERO_NF", "DATA_PROCESSAMENTO")


class Ingest(NamedTuple):
    """What one feed changes. New parties carry the ids that addresses and invoices refer to.

    ``invoices`` have ids of their own, for the schedules. An invoice without a known party or
    term cannot be scheduled and is among the incomplete ones, with the reason. The next
    versions of parties and addresses hold all changes; write them to a new place.
    """

    accepted: DataFrame
    rejected: DataFrame
    processed_log: DataFrame
    new_parties: DataFrame
    changed_parties: DataFrame
    new_addresses: DataFrame
    changed_addresses: DataFrame
    invoices: DataFrame
    incomplete_invoices: DataFrame
    parties_next: DataFrame
    addresses_next: DataFrame
    verdicts: Observation | None = None

    def verdict_counts(self) -> dict[str, int]:
        """Rows of the feed by verdict, OK or the reason of the rejection, counted while the validated feed was staged."""
        return {code: n for code, n in self.verdicts.get.items() if n}


def count_verdicts(validated: DataFrame, rules: list[tuple[Column, str]], reason: str = "MOTIVO") -> tuple[DataFrame, Observation]:
    """``validated``, and its rows by verdict, to be read once it has been written or otherwise run through; no pass of its own."""
    seen = Observation(f"verdicts-{uuid4()}")
    codes = dict.fromkeys([*(code for _, code in rules), ACCEPTED])
    return validated.observe(seen, *[F.count_if(F.col(reason) == code).alias(code) for code in codes]), seen


def validate_feed(feed: DataFrame, processed: DataFrame, postal_codes: DataFrame, layout: Layout) -> DataFrame:
    """Typed feed rows not processed before, distinct, defaults filled in, with MOTIVO and the two flags."""
    defaults = {"NUM_ENDERECO": DEFAULT_NUMBER, "COMPLEMENTO": DEFAULT_TEXT}
    if layout.default_email:
        defaults[layout.email] = DEFAULT_TEXT

    def named(fresh: DataFrame) -> DataFrame:
        # The tax id is judged right after the join, where its parts are computed once per row;
        # on top of the aggregation or inside the rules they would be repeated for each use.
        judged = fresh.withColumn(layout.name, F.upper(layout.name)).withColumn("CNPJ_VALIDO", is_valid_tax_id(layout.tax_id))
        # a company is one party however its id was typed; what is not valid stays as it came
        bare = F.when(F.col("CNPJ_VALIDO"), strip_punctuation(layout.tax_id)).otherwise(F.col(layout.tax_id))
        # the rules never look at a defaulted column, so copies can go before they are judged
        return fill_defaults(judged.withColumn(layout.tax_id, bare), defaults)

    distinct = unprocessed_distinct(feed.select(*layout.feed_columns), processed, LOG_KEY, named, range_column="DATA_PROCESSAMENTO")
    flagged = domain_membership(distinct, postal_codes, "CEP", "CEP_VALIDO")
    rules = feed_rules(layout, tax_id_ok="CNPJ_VALIDO", postal_ok="CEP_VALIDO")
    return flagged.withColumn("MOTIVO", first_failing_rule(rules))


def _ingest(
    validated: DataFrame,
    layout: Layout,
    parties: DataFrame,
    addresses: DataFrame,
    address_types: DataFrame,
    terms: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    keep_known: bool,
    invoices_so_far: DataFrame | int,
) -> Ingest:
    parties = parties.withColumn(layout.tax_id, strip_punctuation(layout.tax_id))
    accepted, rejected = split_valid_rejected(validated, reason="MOTIVO", flags=("CNPJ_VALIDO", "CEP_VALIDO"))
    recency = ("DATA_PROCESSAMENTO", "NUMERO_NF")
    # one row per party of the feed; five outputs read it, and the ids are fixed before sinks run
    offered = stage(
        latest_per_key(accepted, [layout.tax_id], layout.party_attributes, recency, defaults={layout.email: DEFAULT_TEXT})
    )
    entering = stage(
        assign_surrogate_keys(
            new_members(offered, parties, layout.tax_id), layout.tax_id, layout.party_id, start_after=parties
        )
    )
    # the parties of this feed only
    known_ids = ids_of_keys(parties, offered, layout.tax_id, layout.party_id)
    party_ids = stage(known_ids.unionByName(entering.select(layout.tax_id, layout.party_id)))

    type_ids = one_id_per_key(
        address_types.select(F.upper("DESCRICAO").alias("TIPO_ENDERECO"), "ID_TIPO_ENDERECO"), "TIPO_ENDERECO", "ID_TIPO_ENDERECO"
    )
    # one address per (party, postal code) before any join
    delivery = latest_per_key(
        accepted,
        [layout.tax_id, "CEP"],
        ("TIPO_ENDERECO", "NUM_ENDERECO", "COMPLEMENTO"),
        recency,
        defaults={"NUM_ENDERECO": DEFAULT_NUMBER, "COMPLEMENTO": DEFAULT_TEXT},
    )
    located = resolve_party_address(
        delivery, type_ids, party_ids, type_column="TIPO_ENDERECO", party_key=layout.tax_id
    ).select(layout.party_id, "ID_TIPO_ENDERECO", "CEP", F.col("NUM_ENDERECO").alias("NUMERO"), "COMPLEMENTO")
    address_key = [layout.party_id, "CEP"]

    term_ids = one_id_per_key(terms.select(F.col("DESCRICAO").alias("CONDICAO_PAGAMENTO"), "ID_CONDICAO"), "CONDICAO_PAGAMENTO", "ID_CONDICAO")
    canonical = accepted.withColumn("CONDICAO_PAGAMENTO", normalize_term("CONDICAO_PAGAMENTO"))
    facts = build_invoice_fact(
        canonical, party_ids, term_ids, party_key=layout.tax_id, term_column="CONDICAO_PAGAMENTO"
    ).select(layout.party_id, "ID_CONDICAO", *INVOICE_COLUMNS)

    lacking = F.when(F.col(layout.party_id).isNull(), f"{layout.party_id}_NULO").when(F.col("ID_CONDICAO").isNull(), "ID_CONDICAO_NULO")
    complete = facts.where(lacking.isNull())
    invoices = assign_surrogate_keys(
        complete,
        [layout.party_id, "NUMERO_NF"],
        layout.invoice_id,
        ties=[c for c in complete.columns if c not in (layout.party_id, "NUMERO_NF")],
        start_after=invoices_so_far,
    )
    changed = changed_members(
        offered, parties, layout.tax_id, layout.party_attributes, keep_known={layout.email: DEFAULT_TEXT} if keep_known else None
    )
    fresh_addresses = new_addresses(located, addresses, address_key)
    moved = changed_addresses(
        located, addresses, address_key, ADDRESS_COLUMNS,
        keep_known={"NUMERO": DEFAULT_NUMBER, "COMPLEMENTO": DEFAULT_TEXT} if keep_known else None,
    )

    return Ingest(
        accepted=accepted,
        rejected=rejected,
        processed_log=accepted.select(*layout.log_columns),
        new_parties=entering,
        changed_parties=changed,
        new_addresses=fresh_addresses,
        changed_addresses=moved,
        invoices=invoices,
        incomplete_invoices=facts.where(lacking.isNotNull()).withColumn("MOTIVO", lacking),
        parties_next=merge_upsert(parties, changed, [layout.tax_id], layout.party_attributes, insert=False).unionByName(
            entering, allowMissingColumns=True
        ),
        addresses_next=merge_upsert(addresses, moved, address_key, ADDRESS_COLUMNS, insert=False).unionByName(
            fresh_addresses, allowMissingColumns=True
        ),
    )


def purchases_ingest(
    feed: DataFrame,
    *,
    processed: DataFrame,
    postal_codes: DataFrame,
    parties: DataFrame,
    addresses: DataFrame,
    address_types: DataFrame,
    terms: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
    keep_known: bool = False,
    invoices_so_far: DataFrame | int = 0,
) -> Ingest:
    """Ingest a purchase feed of text columns.

    ``stage`` makes the validated feed and the feed's parties available to the outputs that read
    them; the default writes each once as a table in the shared checkpoint folder, a
    :class:`~cashloom.sources.staging.Staging` also takes them away again. The feed itself is read
    once in full and twice for its keys; pass a stored one where that is dear. With
    ``keep_known``, a missing or default value never replaces a known one. New invoices get ids
    after those of ``invoices_so_far``, a table of them or the last id.
    """
    typed = trim_cast_columns(feed, FEED_CASTS).withColumn("TIPO_ENDERECO", F.upper("TIPO_ENDERECO"))
    judged, verdicts = count_verdicts(validate_feed(typed, processed, postal_codes, PURCHASES), feed_rules(PURCHASES, tax_id_ok="CNPJ_VALIDO", postal_ok="CEP_VALIDO"))
    result = _ingest(stage(judged), PURCHASES, parties, addresses, address_types, terms, stage, keep_known, invoices_so_far)
    # rejects are kept with a numeric postal code
    return result._replace(rejected=result.rejected.withColumn("CEP", F.col("CEP").try_cast("int")), verdicts=verdicts)


def sales_ingest(
    feed: DataFrame,
    *,
    processed: DataFrame,
    postal_codes: DataFrame,
    parties: DataFrame,
    addresses: DataFrame,
    address_types: DataFrame,
    terms: DataFrame,
    stage: Callable[[DataFrame], DataFrame] = shared_copy,
    keep_known: bool = False,
    invoices_so_far: DataFrame | int = 0,
) -> Ingest:
    """Ingest a sales feed already typed by its scan; only the invoice number is still text."""
    typed = feed.withColumn("NUMERO_NF", F.col("NUMERO_NF").try_cast("int"))
    judged, verdicts = count_verdicts(validate_feed(typed, processed, postal_codes, SALES), feed_rules(SALES, tax_id_ok="CNPJ_VALIDO", postal_ok="CEP_VALIDO"))
    result = _ingest(stage(judged), SALES, parties, addresses, address_types, terms, stage, keep_known, invoices_so_far)
    return result._replace(verdicts=verdicts)
