"""Joins, windows and grouped operators of the rule jobs.

Every window partitions by ``record_id`` (plus ``ord`` for sibling
order inside a field): a record is bounded (< 100 kB), so no partition
grows with the data and there is no hot key to salt.  Record-level joins
are equi-joins on ``record_id``; code lists are broadcast (fixed size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..plans import common as C

SERIES_8XX = ("800", "810", "811", "830")


def places(subfields: DataFrame) -> DataFrame:
    """The fields of flat subfields by (record_id, ord, tag), dealt by record once: neither telling them
    apart nor a window over the record shuffles again."""
    return subfields.select("record_id", "ord", "tag").repartition("record_id").distinct()


def tag_ordinal(fields: DataFrame) -> DataFrame:
    """Position among the record's fields (1-based, dense over gaps)."""
    w = Window.partitionBy("record_id").orderBy("ord")
    return fields.withColumn("position", F.row_number().over(w).cast("int"))


def series_match(subfields: DataFrame) -> DataFrame:
    """Nth series statement (490) <-> nth 800/810/811/830, full outer.

    490 weight: parallel ($a > 1 and '=') counts 1, several $a count each,
    one $a counts 1, none 0; the rank of a statement is the running sum of
    weights before it plus its $a position.
    """
    s490 = subfields.where(F.col("tag") == "490")
    f = C.nest_fields(s490)
    sfs = F.col("sfs")
    n_a = F.size(F.filter(sfs, lambda s: s["code"] == "a"))
    has_eq = F.exists(sfs, lambda s: F.instr(s["value"], "=") > 0)
    parallel = (n_a > 1) & has_eq
    weight = F.when(parallel, 1).when(n_a > 1, n_a).when(n_a == 1, 1).otherwise(0)
    w = Window.partitionBy("record_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    f = f.withColumn("parallel", parallel).withColumn("cur", F.coalesce(F.sum(weight).over(w), F.lit(0)) + 1)
    a = f.select("record_id", "ord", "sfs", "parallel", "cur",
                 F.posexplode(F.filter(sfs, lambda s: s["code"] == "a")).alias("p", "a"))
    a = a.where(~(F.col("parallel") & (F.col("p") > 0)))
    next_v = F.try_element_at(F.filter(F.col("sfs"), lambda s: (s["code"] == "v") & (s["sf_ord"] > F.col("a.sf_ord"))),
                              F.lit(1))["value"]
    stmt = F.when(F.col("parallel"), C.label(F.col("sfs"), "av")) \
        .otherwise(X.normalize_space(F.concat_ws(" ", F.col("a.value"), next_v)))
    left = a.select("record_id", (F.col("cur") + F.col("p")).cast("int").alias("rank"),
                    F.col("ord").alias("ord_490"), F.col("a.sf_ord").alias("sf_ord_a"),
                    stmt.alias("statement"), next_v.alias("v490"))
    e8 = C.nest_fields(subfields.where(F.col("tag").isin(*SERIES_8XX)))
    e8 = e8.select("record_id", F.row_number().over(Window.partitionBy("record_id").orderBy("ord")).cast("int").alias("rank"),
                   F.col("ord").alias("ord_8xx"), C.first_value(F.col("sfs"), "v").alias("v8xx"))
    j = left.join(e8, ["record_id", "rank"], "full_outer")
    return j.select("record_id", "rank", "ord_490", "sf_ord_a", "statement",
                    F.coalesce("v8xx", "v490").alias("enumeration"), "ord_8xx")


def series_count(subfields: DataFrame) -> DataFrame:
    """The three-way count of series statements per record."""
    f = C.nest_fields(subfields.where(F.col("tag") == "490"))
    sfs = F.col("sfs")
    n_a = F.size(F.filter(sfs, lambda s: s["code"] == "a"))
    has_eq = F.exists(sfs, lambda s: F.instr(s["value"], "=") > 0)
    return f.groupBy("record_id").agg(
        F.count_if((n_a > 1) & has_eq).cast("bigint").alias("n_parallel"),
        F.sum(F.when((n_a > 1) & ~has_eq, n_a).otherwise(0)).cast("bigint").alias("n_multi_a"),
        F.count_if(n_a == 1).cast("bigint").alias("n_single"),
    ).withColumn("count490", F.col("n_parallel") + F.col("n_multi_a") + F.col("n_single"))


def work_title_anti(subfields: DataFrame) -> DataFrame:
    """245 gives the Work title only when the record has no 130 or 240."""
    t245 = C.nest_fields(subfields.where(F.col("tag") == "245"))
    uni = subfields.where(F.col("tag").isin("130", "240")).select("record_id").distinct()
    return t245.join(uni, "record_id", "left_anti").select(
        "record_id", "ord", C.label(F.col("sfs"), "abfgknps").alias("title"))


def shelfmarks(subfields: DataFrame) -> DataFrame:
    """J05 + X19: the shelf mark of each 050 item, its class by the first $a alone, and every 051 of
    the record ($a, $b and $c) as a further mark of it."""
    a, b, c = (C.first_value(F.col("sfs"), x) for x in "abc")
    mark = X.shelf_mark(a, b)
    f050 = C.nest_fields(subfields.where(F.col("tag") == "050")).select(
        "record_id", F.col("ord").alias("ord_050"), X.normalize_space(mark).alias("mark_050"),
        F.when(X.lcc_valid(F.coalesce(a, F.lit(""))), F.lit("ShelfMarkLcc")).otherwise(F.lit("ShelfMark")).alias("class_050"))
    f051 = C.nest_fields(subfields.where(F.col("tag") == "051")).select(
        "record_id", F.col("ord").alias("ord_051"), X.chop_punct(X.normalize_space(F.concat_ws(" ", mark, c))).alias("mark_051"))
    return f050.join(f051, "record_id", "left")


def translation_language(subfields: DataFrame) -> DataFrame:
    """130/240 with $l is a translation; its language is the 041 ind1=1 $h iff exactly one."""
    uni = subfields.where(F.col("tag").isin("130", "240") & (F.col("code") == "l")) \
        .select("record_id", "ord", F.col("value").alias("l"))
    h = subfields.where((F.col("tag") == "041") & (F.col("ind1") == "1") & (F.col("code") == "h")) \
        .groupBy("record_id").agg(F.count("*").alias("n"), F.first("value").alias("h")) \
        .where(F.col("n") == 1).select("record_id", "h")
    return uni.join(h, "record_id", "left").select(
        "record_id", "ord", X.chop_punct("l").alias("part"),
        F.when(F.col("h").isNotNull(), F.concat(F.lit(X.LANGUAGES), F.col("h"))).alias("original_language"))


def next_field_holding(fields: DataFrame) -> DataFrame:
    """A 533 (534) takes the immediately following field as holding when it
    is a 535 (or an 880 linked to 535) with ind1=2 (ind1=1 for 534 per the rule).

    ``fields`` needs record_id, ord, tag, ind1 and either ``sf6`` or nested ``sfs``;
    :func:`field_heads` builds the lean form from flat subfields (a plain hash
    aggregate, no arrays), then one window per record.
    """
    heads = ("record_id", "ord", "tag", "ind1")
    if "sf6" not in fields.columns:
        # only an 880's $6 is looked at: of all other fields no subfield is collected
        linked = F.col("tag").eqNullSafe("880")
        fields = fields.where(~linked).select(*heads, F.lit(None).cast("string").alias("sf6")).unionByName(
            fields.where(linked).select(*heads, C.first_value(F.col("sfs"), "6").alias("sf6")))
    w = Window.partitionBy("record_id").orderBy("ord")
    f = fields.select(*heads, "sf6") \
        .withColumn("nxt", F.lead(F.struct("ord", "tag", "ind1", "sf6")).over(w))
    is535 = (F.col("nxt.tag") == "535") | ((F.col("nxt.tag") == "880") & F.col("nxt.sf6").startswith("535"))
    ok = is535 & (F.col("nxt.ind1") == F.when(F.col("tag") == "533", F.lit("2")).otherwise(F.lit("1")))
    return f.where(F.col("tag").isin("533", "534")).select(
        "record_id", "ord", "tag", F.when(ok, F.col("nxt.ord")).alias("holding_ord"))


def field_heads(subfields: DataFrame) -> DataFrame:
    """One row per field: (record_id, ord, tag, ind1, sf6) from flat subfields.

    Only an 880 is ever asked for its $6; of the other fields the rows are told apart, no more,
    which is a hash aggregate without values (a struct's minimum would sort them all).  Both are dealt by
    record alone, so that a window over the record shuffles neither again."""
    keys = ("record_id", "ord", "tag", "ind1")
    linked = F.col("tag").eqNullSafe("880")
    s6 = F.min(F.when(F.col("code") == "6", F.struct("sf_ord", "value")))
    others = subfields.where(~linked).select(*keys).repartition("record_id").distinct()
    own = subfields.where(linked).repartition("record_id").groupBy(*keys).agg(s6.alias("_s6"))
    return others.withColumn("sf6", F.lit(None).cast("string")).unionByName(own.select(*keys, F.col("_s6.value").alias("sf6")))


def rda_pairs(subfields: DataFrame) -> DataFrame:
    """J08 (336-338): each $b a resource labelled by an immediately preceding $a and
    identified by an immediately following $0; each $a not followed by $b a label
    resource.  A trailing $a yields nothing (the stylesheet compares an empty node)."""
    stems = {"336": "http://id.loc.gov/vocabulary/contentTypes/",
             "337": "http://id.loc.gov/vocabulary/mediaTypes/",
             "338": "http://id.loc.gov/vocabulary/carriers/"}
    s = subfields.where(F.col("tag").isin(*stems))
    w = Window.partitionBy("record_id", "ord").orderBy("sf_ord")
    s = s.withColumn("prev", F.lag(F.struct("code", "value")).over(w)) \
        .withColumn("nxt", F.lead(F.struct("code", "value")).over(w))
    stem = F.coalesce(*[F.when(F.col("tag") == k, F.lit(v)) for k, v in stems.items()])
    b = s.where(F.col("code") == "b").select(
        "record_id", "ord", "tag", "sf_ord", F.concat(stem, F.col("value")).alias("uri"),
        F.when(F.col("prev.code") == "a", F.col("prev.value")).alias("label"),
        F.when(F.col("nxt.code") == "0", F.col("nxt.value")).alias("id0"))
    a = s.where((F.col("code") == "a") & (F.col("nxt.code") != "b")).select(
        "record_id", "ord", "tag", "sf_ord", F.lit(None).cast("string").alias("uri"), F.col("value").alias("label"),
        F.when(F.col("nxt.code") == "0", F.col("nxt.value")).alias("id0"))
    return b.unionByName(a)


def following_code(subfields: DataFrame, tag: str = "033", first: str = "b", then: str = "c") -> DataFrame:
    """A $b paired with the immediately following $c (033, 352)."""
    s = subfields.where(F.col("tag") == tag)
    w = Window.partitionBy("record_id", "ord").orderBy("sf_ord")
    s = s.withColumn("nxt", F.lead(F.struct("code", "value")).over(w))
    return s.where(F.col("code") == first).select(
        "record_id", "ord", "sf_ord", F.col("value").alias(first),
        F.when(F.col("nxt.code") == then, F.col("nxt.value")).alias(then))


def before_after_t(subfields: DataFrame, tags=("600", "700")) -> DataFrame:
    """Each subfield of a field with $t is before or after the first $t."""
    s = subfields.where(F.col("tag").isin(*tags))
    w = Window.partitionBy("record_id", "ord")
    s = s.withColumn("t_pos", F.min(F.when(F.col("code") == "t", F.col("sf_ord"))).over(w))
    return s.where(F.col("t_pos").isNotNull()).select(
        "record_id", "ord", "sf_ord", "code",
        F.when(F.col("sf_ord") < F.col("t_pos"), F.lit("before")).otherwise(F.lit("after")).alias("side"))


# --- fixed values: subject thesaurus by second indicator --------------------
THESAURUS = [
    ("0", "lcsh", ["http://id.loc.gov/authorities/subjects"]),
    ("1", "lcshac", ["http://id.loc.gov/authorities/subjects", "http://id.loc.gov/authorities/childrensSubjects"]),
    ("2", "mesh", []),
    ("3", "nal", []),
    ("5", "cash", []),
    ("6", "rvm", []),
]
# ---------------------------------------------------------------------------


def thesaurus(spark) -> DataFrame:
    rows = [(i, c, s) for i, c, s in THESAURUS]
    return spark.createDataFrame(rows, "ind2 string, code string, schemes array<string>")


def subject_schemes(fields: DataFrame, spark) -> DataFrame:
    """Source code and 0..2 schemes by ind2 (left join to a broadcast code list)."""
    subj = fields.where(F.col("tag").isin("600", "610", "611", "630", "648", "650", "651", "655"))
    j = subj.join(F.broadcast(thesaurus(spark)), "ind2", "left")
    return j.select("record_id", "ord", "tag", "ind2", F.col("code").alias("source"),
                    F.explode_outer("schemes").alias("scheme"))


def borrowed_title(fields: DataFrame) -> DataFrame:
    """530/533/534 and 856 copies reuse the record's title: 245 for
    reproductions; 130, else 240, else 245 for the work title."""
    def first_label(tag, codes):
        return fields.where(F.col("tag") == tag).groupBy("record_id").agg(
            F.min_by(C.label(F.col("sfs"), codes), F.col("ord")).alias(f"t{tag}"))
    copies = fields.where(F.col("tag").isin("530", "533", "534", "856")).select("record_id", "ord", "tag")
    j = (copies.join(first_label("245", "abfgknps"), "record_id", "left")
         .join(first_label("130", "adfgklmnoprs"), "record_id", "left")
         .join(first_label("240", "adfgklmnoprs"), "record_id", "left"))
    return j.select("record_id", "ord", "tag", F.col("t245").alias("instance_title"),
                    F.coalesce("t130", "t240", "t245").alias("work_title"))


def rda_media_anti(records: DataFrame, subfields: DataFrame) -> DataFrame:
    """Media / carrier from 007 only when the record has no 337 / no 338."""
    has337 = subfields.where(F.col("tag") == "337").select("record_id").distinct()
    has338 = subfields.where(F.col("tag") == "338").select("record_id").distinct()
    r = records.where(F.col("c007").isNotNull()).select("record_id", F.substring("c007", 1, 1).alias("category"))
    media = r.join(has337, "record_id", "left_anti").select("record_id", F.lit("media").alias("prop"), "category")
    carrier = r.join(has338, "record_id", "left_anti").select("record_id", F.lit("carrier").alias("prop"), "category")
    return media.unionByName(carrier)


def extra_identifiers(subfields: DataFrame, tags=("600", "700")) -> DataFrame:
    """The first qualifying $0/$w is the URI; the others become identifiers."""
    s = subfields.where(F.col("tag").isin(*tags) & F.col("code").isin("0", "w"))
    q = X.is_uri_identifier("value")
    w = Window.partitionBy("record_id", "ord", q).orderBy("sf_ord")
    s = s.withColumn("rn", F.row_number().over(w)).withColumn("q", q)
    extra = s.where(~F.col("q") | (F.col("rn") > 1))
    v = X.control_number_value("value")
    return extra.select("record_id", "ord", "sf_ord", X.control_number_source("value").alias("source"),
                        v.alias("id_value"))


def music_medium_counts(subfields: DataFrame) -> DataFrame:
    """W04 (382): counts ($n/$e) belong to the nearest preceding medium ($a $b $d $p)
    when no $r/$s/$t lies between, and only if some boundary follows them."""
    s = subfields.where(F.col("tag") == "382")
    bound = F.col("code").isin("a", "b", "d", "p", "r", "s", "t")
    w = Window.partitionBy("record_id", "ord").orderBy("sf_ord")
    prev_b = F.last(F.when(bound, F.struct("code", "sf_ord", "value")), ignorenulls=True) \
        .over(w.rowsBetween(Window.unboundedPreceding, -1))
    next_b = F.first(F.when(bound, F.col("sf_ord")), ignorenulls=True) \
        .over(w.rowsBetween(1, Window.unboundedFollowing))
    s = s.withColumn("pb", prev_b).withColumn("nb", next_b)
    cnt = s.where(F.col("code").isin("n", "e") & F.col("pb.code").isin("a", "b", "d", "p") & F.col("nb").isNotNull())
    return cnt.select("record_id", "ord", F.col("pb.sf_ord").alias("medium_sf"), F.col("pb.value").alias("medium"),
                      F.col("value").alias("count"))


def class_items(subfields: DataFrame, tags=("050", "060", "082", "084")) -> DataFrame:
    """Each $a a classification portion; the first $b goes with the first $a only."""
    f = C.nest_fields(subfields.where(F.col("tag").isin(*tags)))
    b1 = C.first_value(F.col("sfs"), "b")
    a = f.select("record_id", "ord", "tag", b1.alias("b1"),
                 F.posexplode(F.filter("sfs", lambda s: s["code"] == "a")).alias("p", "a"))
    return a.select("record_id", "ord", "tag", F.col("a.value").alias("class_portion"),
                    F.when(F.col("p") == 0, F.col("b1")).alias("item_portion"),
                    (X.lcc_valid(F.col("a.value")) | (F.col("tag") != "050")).alias("valid"))


def item_grouping(fields: DataFrame, records: DataFrame) -> DataFrame:
    """541/561/563/583 without $3/$5 merge into one item named by the first;
    those with $3/$5 are their own items."""
    f = C.with_uri(fields.where(F.col("tag").isin("541", "561", "563", "583")), records)
    own = F.exists("sfs", lambda s: s["code"].isin("3", "5"))
    w = Window.partitionBy("record_id", own).orderBy("ord")
    first = F.first(F.struct("tag", "ord")).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tag = F.when(own, F.col("tag")).otherwise(first["tag"])
    o = F.when(own, F.col("ord")).otherwise(first["ord"])
    return f.select("record_id", "ord", "tag", own.alias("own_item"),
                    F.concat(F.col("ruri"), F.lit("#Item"), tag, F.lit("-"), o.cast("string")).alias("item_uri"))


# --- fixed values: subfields of a subject's label, by tag -------------------------
SUBJECT_CODES = {"648": "avxyz", "650": "abcdvxyz", "651": "abvxyz", "655": "avxyz"}
# ----------------------------------------------------------------------------------


def subject_label(subfields: DataFrame) -> DataFrame:
    """Label of 648/650/651 and 655 (first indicator blank): the tag's components, each
    followed by '--', in document order, without what of ``- `` ends it."""
    codes = F.create_map(*[F.lit(x) for row in SUBJECT_CODES.items() for x in row])
    s = subfields.where(F.col("tag").isin(*SUBJECT_CODES) & ((F.col("tag") != "655") | (F.col("ind1") == " "))
                        & (F.instr(codes[F.col("tag")], F.col("code")) > 0))
    g = s.groupBy("record_id", "ord").agg(F.array_sort(F.collect_list(F.struct("sf_ord", "value"))).alias("p"))
    whole = F.array_join(F.transform("p", lambda x: F.concat(x["value"], F.lit("--"))), "")
    return g.select("record_id", "ord", X.rtrim_set(whole, "- ").alias("label"))


def holding_address(subfields: DataFrame) -> DataFrame:
    """Address of 850/852: $e and $n in document order, each followed by ', ', chopped."""
    s = subfields.where(F.col("tag").isin("850", "852") & F.col("code").isin("e", "n"))
    g = s.groupBy("record_id", "ord").agg(F.array_sort(F.collect_list(F.struct("sf_ord", "value"))).alias("p"))
    whole = F.array_join(F.transform("p", lambda x: F.concat(x["value"], F.lit(", "))), "")
    return g.select("record_id", "ord", X.chop_punct(whole).alias("address"))
