"""The whole conversion (A06, T01): every rule job over one catalogue.

A catalogue is decoded once into one row per record: the header's control fields and the data
fields with their subfields as nested arrays (``operators.decode.decode_records``).  The header
table and the fields table are projections of it, no shuffle in between; written clustered by tag,
each rule's filter on its tags skips the row groups of the others, so the scans of all rules
together read the fields about once.  ``convert`` is the union of the rules; as a graph is a set,
``graph`` removes what two rules of one record both say.  A micro-batch is a catalogue like
another, so a stream converts with the same rules.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from . import access, acquisition, admin, capture, classification, common, control, copies, coverage, fixed, holdings, instruments, links, names, physical
from . import publication, record, ruletable, series, subjects, titles, uniform

TRIPLE = ["record_id", "subj", "pred", "obj", "obj_kind", "lang", "datatype"]

#: ISO 639-2 to xml:lang, for linked fields; callers may pass their own.
LANGUAGES = [("eng", "en"), ("fre", "fr"), ("ger", "de"), ("spa", "es"), ("ita", "it"), ("rus", "ru"),
             ("chi", "zh"), ("jpn", "ja"), ("kor", "ko"), ("ara", "ar"), ("heb", "he"), ("gre", "el")]


class Catalogue(NamedTuple):
    """``headers``: record_id, leader, c001, c003, c005, c007, c008, ruri.  ``fields``: record_id, ord, tag, ind1,
    ind2, sfs (sf_ord, code, value in order), eff_tag, ruri and, of linked fields, lang."""

    spark: SparkSession
    headers: DataFrame
    fields: DataFrame

    @property
    def uris(self) -> DataFrame:
        return self.headers.select("record_id", "ruri")

    @property
    def subfields(self) -> DataFrame:
        return self.fields.select("record_id", "ord", "tag", "ind1", "ind2", "ruri", F.inline("sfs"))


class Rule(NamedTuple):
    name: str
    build: Callable[[Catalogue], DataFrame]


RULES = (
    Rule("record_frame", lambda c: record.record_frame(c.headers)),
    Rule("leader_types", lambda c: record.leader_types(c.spark, c.headers)),
    Rule("admin_metadata", lambda c: record.admin_control(c.headers)),
    Rule("physical_007_work", lambda c: physical.physical_007_work(c.spark, c.headers)),
    Rule("physical_007_instance", lambda c: physical.physical_007_instance(c.spark, c.headers, c.fields)),
    Rule("fixed_field_work", lambda c: fixed.fixed_field_work(c.spark, c.headers)),
    Rule("fixed_field_instance", lambda c: fixed.fixed_field_instance(c.headers, c.spark)),
    Rule("admin_fields", lambda c: admin.admin_fields(c.fields)),
    Rule("capture_events", lambda c: capture.capture_events(c.fields, c.uris)),
    Rule("cartography", lambda c: coverage.cartography(c.fields, c.uris)),
    Rule("coverage", lambda c: coverage.coverage(c.fields, c.uris)),
    Rule("lookup_instrument", lambda c: instruments.instruments(c.spark, c.subfields, c.uris)),
    Rule("instance_ids", lambda c: ruletable.instance_ids(c.spark, c.subfields, c.fields, c.uris)),
    Rule("acquisition", lambda c: acquisition.acquisition(c.fields, c.uris)),
    Rule("classification", lambda c: classification.classification(c.fields, c.uris)),
    Rule("shelf_items", lambda c: classification.shelf_items(c.fields, c.uris)),
    Rule("government_documents", lambda c: classification.government_documents(c.fields, c.uris)),
    Rule("contributions", lambda c: names.contributions(c.uris, c.fields)),
    Rule("agent_keys", lambda c: names.agent_keys(c.uris, c.fields)),
    Rule("subject_names", lambda c: names.subject_names(c.spark, c.uris, c.fields)),
    Rule("title_parts", lambda c: titles.title_245(c.fields, c.uris)),
    Rule("alternate_script", lambda c: titles.title_245(c.fields, c.uris, alternate=True)),
    Rule("variant_titles", lambda c: titles.variant_246(c.fields, c.uris)),
    Rule("uniform_titles", lambda c: uniform.uniform_titles(c.fields, c.uris)),
    Rule("publication_events", lambda c: publication.publication_events(c.fields, c.uris)),
    Rule("property_map_3xx", lambda c: ruletable.subfield_rules(c.spark, c.subfields, c.uris, ruletable.PROPERTY_3XX, "R21")),
    Rule("work_notes", lambda c: ruletable.work_notes(c.spark, c.fields, c.subfields, c.uris)),
    Rule("instance_notes", lambda c: ruletable.instance_notes(c.spark, c.fields, c.uris)),
    Rule("reproductions", lambda c: copies.reproductions(c.fields, c.uris)),
    Rule("subject_components", lambda c: subjects.subjects(c.spark, c.fields, c.uris)),
    Rule("keywords", lambda c: subjects.keywords(c.fields, c.uris)),
    Rule("hierarchical_places", lambda c: links.hierarchical_places(c.fields, c.uris)),
    Rule("linking_entries", lambda c: links.linking_entries(c.spark, c.fields, c.uris)),
    Rule("holdings", lambda c: holdings.holdings(c.fields, c.uris)),
    Rule("online_access", lambda c: access.online_access(c.fields, c.headers)),
    Rule("series_entries", lambda c: series.series_entries(c.fields, c.uris)),
    Rule("control_subfields", lambda c: control.control_subfields(c.subfields)),
)


def linked_language(languages: list[tuple[str, str]] = LANGUAGES) -> Column:
    """The xml:lang of a linked field (880), from the record's language (``lang008``) and the script that $6 names."""
    known = F.create_map(*[F.lit(x) for pair in languages for x in pair])
    sf6 = common.first_value(F.col("sfs"), "6")
    script, lang = X.script_name(sf6, F.col("lang008")), F.element_at(known, F.col("lang008"))
    ok = (F.col("tag") == "880") & (F.coalesce(lang, F.lit("")) != "") & (F.coalesce(script, F.lit("")) != "")
    return F.when(ok, F.concat(lang, F.lit("-"), script))


def catalogue(spark: SparkSession, records: DataFrame, base: str = common.BASE_URI, languages: list[tuple[str, str]] = LANGUAGES) -> Catalogue:
    """The catalogue of decoded records (``operators.decode.decode_records``): projections of one row per record."""
    headers = common.with_record_uri(records, base=base)
    headers = headers.withColumn("c007", F.try_element_at("c007s", F.lit(1)))
    lang008 = F.substring("c008", 36, 3)
    fields = headers.select("record_id", "ruri", lang008.alias("lang008"), F.inline("fields"))
    fields = common.with_eff_tag(fields)
    return Catalogue(spark, headers.drop("fields"), fields.withColumn("lang", linked_language(languages)))


def clustered(fields: DataFrame) -> DataFrame:
    """Fields sorted by tag within each partition: a table written so lets a rule's tag filter skip row groups."""
    return fields.sortWithinPartitions("tag")


def convert(source: Catalogue, rules: tuple[Rule, ...] = RULES, threads: int = 8) -> DataFrame:
    """The triples of all rules, with the name of the rule that made each.  The rules' plans are built side by
    side: analysing thirty plans one after another takes longer than running them over a small batch."""
    def build(rule: Rule) -> DataFrame:
        return rule.build(source).select(*TRIPLE, F.lit(rule.name).alias("rule"))

    with ThreadPoolExecutor(threads) as pool:
        made = list(pool.map(build, rules))
    while len(made) > 1:
        made = [a.union(b) for a, b in zip(made[::2], made[1::2])] + made[len(made) - len(made) % 2:]
    return made[0]


def graph(triples: DataFrame) -> DataFrame:
    """The triples of each record as a set: one shuffle, by record as the stored graph is dealt.  Few triples are said
    twice, so they are told apart after the shuffle, not before it as well."""
    return triples.select(*TRIPLE).repartition("record_id").distinct()
