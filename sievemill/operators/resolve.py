"""Entity resolution: name and address keys, duplicate groups and decisions on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemill.functions import tags, urls
from sievemill.functions import text as X

from sievemill.sources.files import with_long_texts
from sievemill.sources.shared_tables import written

from .chunk import global_positions
from .components import connected_components
from .link import keys_of_groups

# Names too general to tell a resource by.
STATEMENT = 20
GENERIC_NAMES = ["database", "databases", "resource", "resources", "repository", "portal", "website", "webserver"]
# What a name ends in that says nothing, versions, names in brackets, and leading acronyms.
ENDING = r"(?:\b(?:database|db)\b\s*)+$"
VERSION = r"\b(?:version|release|v)\s*\d+(?:\.\d+)*\b"
BRACKETS = r"\(([^()]{2,40})\)"
ALIAS = r"^[A-Za-z][A-Za-z0-9_-]{1,15}$"
ACRONYM = r"^([A-Z][A-Z0-9_-]{1,14})\s*[:\-]"
# Statuses under which a final address counts as evidence.
FOLLOWED = ["reachable", "restricted", "continue_required"]
#: Rows that hold their group's list are made in pieces of so many rows, and a group has at most so many pieces.
PIECE_ROWS, PIECES = 10_000, 32


def name_key(c: Column) -> Column:
    """A name in letters and digits, less closing "database" and version numbers; placeholders are empty."""

    def of(text: Column) -> Column:
        short = X.strip(F.regexp_replace(text, ENDING, ""))
        short = F.regexp_replace(short, VERSION, "")
        return F.when(text.isin(X.MISSING_NAME), F.lit("")).otherwise(F.regexp_replace(short, "[^a-z0-9]+", ""))

    return X.let(F.replace(F.lower(X.clean(c)), F.lit("&"), F.lit(" and ")), of)


def name_keys(c: Column) -> Column:
    """Keys of a name: all of it, aliases in brackets, and a leading acronym."""

    def of(text: Column) -> Column:
        aliases = F.filter(F.regexp_extract_all(text, F.lit(BRACKETS), F.lit(1)), lambda a: X.strip(a).rlike(ALIAS))
        leading = F.regexp_extract(text, ACRONYM, 1)
        keys = F.transform(F.concat(F.array(text), aliases, F.array(leading)), name_key)
        return F.array_distinct(F.filter(keys, lambda k: (k != "") & ~k.isin(GENERIC_NAMES)))

    return X.let(X.clean(c), of)


def numbered_groups(members: DataFrame, prefix: str) -> DataFrame:
    """Groups of more than one member, numbered by their smallest: ``group, component, n``. The numbering sees a row for each group
    only, and sorts by ranges."""
    groups = members.groupBy("component").agg(F.count("*").alias("n")).filter("n > 1")
    return global_positions(groups, ["component"], "number").select(F.format_string(f"{prefix}_%04d", "number").alias("group"), "component", "n")


def ranked(df: DataFrame, row_id: str) -> DataFrame:
    """``id, rank`` of the distinct ids in the order of ``sort_id``, written. Graphs are built on ranks, so that the smallest member of
    a group, the order of members and that of groups are those of ids."""
    own = df.select(F.col(row_id).alias("id")).filter("id is not null").distinct().withColumn("_by", X.sort_id(F.col("id")))
    return written(global_positions(own, ["_by", "id"], "rank").select("id", "rank"), "ranks")[0]


def on_ranks(df: DataFrame, ranks: DataFrame, row_id: str) -> DataFrame:
    """The rows with their rank in place of the id."""
    return df.join(ranks.select(F.col("id").alias(row_id), F.col("rank").alias("_rank")), row_id).drop(row_id).withColumnRenamed("_rank", row_id)


def member_lists(members: DataFrame, ranks: DataFrame) -> DataFrame:
    """``component, members``: one row with the ids of each group in order, joined by semicolons. For tables that people read; a group
    has to fit one row. ``members`` has ranks as ids."""
    own = F.array_sort(F.collect_list(F.struct("rank", F.col("name").cast("string").alias("name"))))
    named = members.join(ranks.select(F.col("id").alias("name"), "rank"), F.col("id") == F.col("rank"))
    return named.groupBy("component").agg(own.alias("m")).filter(F.size("m") > 1).select("component", F.array_join(F.transform("m", lambda x: x["name"]), ";").alias("members"))


def rows_with_lists(members: DataFrame, ranks: DataFrame, groups: DataFrame) -> DataFrame:
    """``id, group, members``: a row for each member with the list of all, which a group of g rows holds g times. A large group's rows
    are dealt over tasks in pieces, each of which gets the list once, so that no task makes all of them. Where a group has several
    pieces, the rows come in a session of their own, whose writers keep a list once in a file. ``members`` has ranks as ids, ``groups``
    has ``component, group, n``."""
    spark = members.sparkSession
    cut = F.least(F.lit(PIECES), F.ceil(F.col("n") / PIECE_ROWS)).cast("int")
    named = members.withColumnRenamed("id", "rank").join(ranks, "rank").join(groups.select("component", "group", cut.alias("cut")), "component")
    own = named.select("id", "group", "component", F.pmod(F.xxhash64("rank"), "cut").cast("int").alias("piece"))
    pieces = groups.select("component", F.explode(F.sequence(F.lit(0), cut - 1)).alias("piece"))
    # Merge joins with the short rows on the left make one row at a time; a join that looks up short rows for a list, or an explode,
    # holds all that belong to it. By number, as adaptive execution would put pieces together that are small only before the join.
    lists = pieces.hint("merge").join(member_lists(members, ranks), "component")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = [df.repartition(parts, "component", "piece") for df in (own, lists)]
    rows = dealt[0].hint("merge").join(dealt[1], ["component", "piece"]).select("id", "group", "members")
    large = members.groupBy("component").count().filter(F.col("count") > PIECE_ROWS)
    return rows if large.isEmpty() else with_long_texts(rows, "members")


def shared_by_all(keys: DataFrame, members: DataFrame) -> DataFrame:
    """Groups of which one key is held by every member."""
    sizes = members.groupBy("component").agg(F.countDistinct("id").alias("n"))
    held = keys.join(members, "id").groupBy("component", "key").agg(F.countDistinct("id").alias("k"))
    return held.join(sizes, "component").filter("k = n and n > 1").select("component").distinct()


def duplicate_candidates(df: DataFrame, row_id: str, names: Column | None, address: Column | None, prefix: str = "dup", lists: bool = True) -> DataFrame:
    """Rows that share a name or address key, directly or through others: ``id, group, members, candidate_count, match_basis``. The
    basis is ``name``, ``url`` or both where all members share such a key, else ``transitive``. Without ``lists`` the members are left
    out, which a group of g rows would hold g times."""
    ranks = ranked(df, row_id)
    df = on_ranks(df, ranks, row_id)
    kinds = {}
    if names is not None:
        kinds["name"] = keys_of_groups(df, row_id, names)
    if address is not None:
        kinds["url"] = keys_of_groups(df, row_id, F.filter(address, lambda k: k != ""))
    edges = None
    for keys in kinds.values():
        own = keys.select(F.col("id").alias("src"), F.col("first_id").alias("dst"))
        edges = own if edges is None else edges.union(own)
    members = connected_components(edges.filter("src <> dst"))
    groups = numbered_groups(members, prefix)
    basis = [F.when(F.col(f"_{k}").isNotNull(), F.lit(k)) for k in kinds]
    for kind, keys in kinds.items():
        groups = groups.join(shared_by_all(keys, members).withColumn(f"_{kind}", F.lit(True)), "component", "left")
    joined = F.concat_ws(";", *basis)
    groups = groups.withColumn("match_basis", F.when(joined == "", F.lit("transitive")).otherwise(joined))
    if lists:
        groups = groups.join(member_lists(members, ranks), "component")
    named = members.withColumnRenamed("id", "rank").join(ranks, "rank")
    return named.join(groups, "component").select("id", "group", *(["members"] if lists else []), F.col("n").alias("candidate_count"), "match_basis")


def catalog_duplicates(df: DataFrame, audit: DataFrame | None, row_id: str = "id", name: str = "database_name", url: str = "database_url", decision: str = "db_type_confirmation") -> DataFrame:
    """Duplicate candidates among the rows decided yes; audited final addresses count where something answered."""
    twice = df.groupBy(row_id).count().filter("count > 1").select(row_id).limit(1).collect()
    if twice:
        raise ValueError(f"duplicate id: {twice[0][0]}")
    rows = df.filter(F.lower(X.clean(F.col(decision))) == "yes")
    address = F.array(urls.database_url_key(F.col(url)))
    if audit is not None:
        final = audit.filter(F.col("status").isin(FOLLOWED)).select(row_id, F.col("final_url").alias("_final"))
        rows = rows.join(final, row_id, "left")
        address = F.concat(address, F.array(urls.database_url_key(F.col("_final"))))
    return duplicate_candidates(rows, row_id, name_keys(F.col(name)), F.array_distinct(address))


def check_decisions(df: DataFrame, group: str = "group", row_id: str = "id", action: str = "action", canonical: str = "canonical", representative: str = "representative", members: str | None = None, statement: str | None = None) -> DataFrame:
    """Groups whose decisions contradict themselves: ``group, rule``. ``members``: a column with the group's candidates, which have to be
    the rows decided on; ``statement``: one with the reason, of at least STATEMENT characters."""
    declared = F.array_sort(F.array_distinct(F.transform(tags.split_tags(F.col(members)), X.clean_id))) if members else F.lit(None).cast("array<string>")
    short = F.length(X.clean(F.col(statement))) < STATEMENT if statement else F.lit(False)
    own = F.col(representative).cast("string") == F.col(row_id).cast("string")
    df = df.withColumn("_declared", declared).withColumn("_short", short).withColumn("_own", own)
    g = df.groupBy(group).agg(F.collect_set("_declared").alias("declared"), F.bool_or("_short").alias("short"), F.bool_and("_own").alias("own"), F.array_sort(F.collect_set(X.clean_id(F.col(row_id)))).alias("texts"), F.collect_set(action).alias("actions"), F.collect_set(canonical).alias("names"), F.collect_set(representative).alias("reps"), F.collect_set(row_id).alias("ids"), F.count("*").alias("n"))
    merge = F.array_contains("actions", "merge")
    rules = {
        "mixed_action": F.size("actions") > 1,
        "unknown_action": F.size(F.array_except("actions", F.array(F.lit("merge"), F.lit("split")))) > 0,
        "several_names": merge & (F.size("names") > 1),
        "several_representatives": merge & (F.size("reps") > 1),
        "foreign_representative": merge & (F.size(F.array_except("reps", "ids")) > 0),
        "split_needs_own_names": ~merge & (F.size("names") < F.col("n")),
        "split_represents_itself": ~merge & ~F.coalesce("own", F.lit(False)),
        "blank_name": merge & F.exists("names", lambda n: X.clean(n) == ""),
        **({"other_members": (F.size("declared") != 1) | (F.element_at("declared", 1) != F.col("texts"))} if members else {}),
        "short_statement": F.col("short"),
    }
    broken = F.filter(F.array(*[F.when(cond, F.lit(rule)) for rule, cond in rules.items()]), lambda r: r.isNotNull())
    return g.select(group, F.explode(broken).alias("rule"))


def apply_merges(df: DataFrame, decisions: DataFrame, row_id: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """Rows after merging, and the removed ids with their representatives. ``decisions``: ``id, representative`` of merged rows. The
    representative's yes/no flag is yes if any member's is."""
    merged = decisions.select(F.col("id").alias(row_id), F.col("representative").alias("_rep"))
    joined = df.join(merged, row_id, "left").withColumn("_rep", F.coalesce("_rep", row_id))
    any_yes = joined.groupBy("_rep").agg(F.bool_or(F.lower(X.clean(F.col(flag))) == "yes").alias("_any"), F.count("*").alias("_n")).filter("_n > 1").select(F.col("_rep").alias(row_id), "_any")
    kept = joined.filter(F.col("_rep") == F.col(row_id)).join(any_yes, row_id, "left")
    value = F.when(F.col("_any"), F.lit("yes")).otherwise(F.col(flag))
    removed = joined.filter(F.col("_rep") != F.col(row_id)).select(row_id, F.col("_rep").alias("representative"))
    return kept.select(*[value.alias(c) if c == flag else F.col(c) for c in df.columns]), removed


def unresolved(groups: DataFrame, split: DataFrame) -> DataFrame:
    """Groups that no decision to split names by the same members."""
    return groups.select("group", "members").distinct().join(split.select("members").distinct(), "members", "left_anti")


def incremental_groups(df: DataFrame, canonical: DataFrame, duplicates: DataFrame, prefix: str = "incremental_dup") -> DataFrame:
    """Duplicate groups and canonical names of several representatives, overlapping sets united: ``id, group, members``. Both are edge
    tables: ``canonical`` has ``id, name``, ``duplicates`` ``id, group``."""
    known = df.select("id").distinct()
    foreign = canonical.select("id").union(duplicates.select("id")).distinct().join(known, "id", "left_anti").limit(1).collect()
    if foreign:
        raise ValueError(f"unknown id: {foreign[0][0]}")
    ranks = ranked(known, "id")
    by_name = keys_of_groups(on_ranks(canonical, ranks, "id"), "id", F.array("name"))
    by_group = keys_of_groups(on_ranks(duplicates, ranks, "id"), "id", F.array("group"))
    both = by_name.union(by_group)
    members = connected_components(both.select(F.col("id").alias("src"), F.col("first_id").alias("dst")).filter("src <> dst"))
    return rows_with_lists(members, ranks, numbered_groups(members, prefix))


def single_representatives(df: DataFrame, group: str, canonical: str, representative: str, row_id: str) -> DataFrame:
    """Groups by candidate group and canonical name: members, representatives, and whether the one representative is a member."""
    key = F.coalesce(F.when(X.clean(F.col(group)) != "", X.clean(F.col(group))), F.concat(F.lit("row:"), F.col(row_id).cast("string")))
    g = df.groupBy(key.alias("group_key"), F.col(canonical).alias("canonical")).agg(F.collect_set(row_id).alias("ids"), F.collect_set(representative).alias("reps"))
    ok = (F.size("reps") == 1) & (F.size(F.array_except("reps", "ids")) == 0)
    return g.select("group_key", "canonical", F.size("ids").alias("n"), ok.alias("valid"))


def incremental_candidates(final: DataFrame, canonical: DataFrame | None = None, row_id: str = "id") -> DataFrame:
    """``id, group, members`` of the groups that have to be decided on: duplicates among the final rows, and representatives that share
    a canonical name (``canonical``: ``name, representative`` of an earlier audit), overlapping sets united."""
    found = catalog_duplicates(final, None, row_id).select("id", "group")
    names = final.select(F.col(row_id).alias("id"), F.lit(None).cast("string").alias("name")).limit(0)
    if canonical is not None:
        kept = canonical.filter((X.clean(F.col("name")) != "") & (X.clean(F.col("representative")) != ""))
        names = kept.select(F.col("representative").cast(final.schema[row_id].dataType).alias("id"), X.clean(F.col("name")).alias("name")).distinct()
    return incremental_groups(final.select(F.col(row_id).alias("id")), names, found)


def check_against_candidates(decisions: DataFrame, candidates: DataFrame) -> None:
    """Decisions have to be on the candidates' rows, in the candidates' groups; anything else is an error."""
    own = decisions.select(X.clean_id(F.col("id")).alias("id"), X.clean(F.col("group")).alias("group"), F.lit(1).alias("decided"))
    theirs = candidates.select(X.clean_id(F.col("id")).alias("id"), F.col("group"), F.lit(1).alias("asked"))
    sides = own.groupBy("id", "group").agg(F.count("*").alias("decided")).join(theirs, ["id", "group"], "full")
    bad = sides.filter("asked is null or decided is null or decided > 1").orderBy(X.sort_id(F.col("id")), "group").limit(1).collect()
    if bad:
        what = "is no candidate" if bad[0].asked is None else "lacks a decision" if bad[0].decided is None else "is decided twice"
        raise ValueError(f"{bad[0].group}: id {bad[0].id} {what}")


def apply_incremental(final: DataFrame, decisions: DataFrame, row_id: str = "id", flag: str = "original48", canonical: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Final rows after decisions on the groups found among them, and an audit row for each group: ``canonical, representative,
    member_ids, removed_ids, member_count, action``. ``decisions``: ``group, id, action, canonical, representative`` of every row of
    ``incremental_candidates``. Decisions on other rows or that contradict themselves are an error, and so are duplicates that then
    remain without a decision to split just these members."""
    check_against_candidates(decisions, incremental_candidates(final, canonical, row_id))
    broken = check_decisions(decisions).orderBy("group", "rule").limit(1).collect()
    if broken:
        raise ValueError(f"{broken[0].group}: {broken[0].rule}")
    merged = decisions.filter("action = 'merge' and id <> representative").select("id", "representative")
    kept, _ = apply_merges(final, merged, row_id, flag)
    order = lambda c: F.array_join(X.ordered_ids(c), ";")
    gone = F.collect_list(F.when((F.col("action") == "merge") & (F.col("id") != F.col("representative")), F.col("id")))
    audit = decisions.groupBy("group", "action").agg(
        F.first("canonical").alias("canonical"), F.min(F.when(F.col("action") == "merge", F.col("representative"))).alias("representative"), order(F.collect_set("id")).alias("member_ids"), order(gone).alias("removed_ids"), F.countDistinct("id").alias("member_count")
    )
    left = catalog_duplicates(kept, None, row_id)
    split = audit.filter("action = 'split'").select(F.col("member_ids").alias("members"))
    if not unresolved(left, split).isEmpty():
        raise ValueError("unresolved duplicates remain after the decisions")
    return kept, audit


def canonical_groups(reviewed: DataFrame, row_id: str = "id", group: str = "group", members: str = "members", canonical: str = "canonical", representative: str = "representative", flag: str = "original48", decision: str | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Reviewed rows, with ``decision`` those decided yes, by candidate group (or row) and canonical name: ``group_key, canonical, representative, member_ids, removed_ids,
    member_count, flag, rule``. The rule names what contradicts: members outside a candidate group, several representatives, or one
    that is no member; it is null for a good group. ``candidates``: ``group, id`` of the candidate groups' members, in place of the
    column ``members``, which holds the list of a group of g rows g times; each row then meets its own entry, and one without a
    group stands for itself."""
    text, own = lambda c: X.clean(F.col(c)), lambda c: X.clean_id(F.col(c))
    if decision is not None:
        reviewed = reviewed.filter(F.lower(text(decision)) == "yes")
    key = F.coalesce(F.when(text(group) != "", text(group)), F.concat(F.lit("row:"), own(row_id)))
    if candidates is None:
        lists = F.collect_set(F.array_sort(F.transform(tags.split_tags(F.col(members)), X.clean_id)))
        foreign = F.exists("allowed", lambda a: F.size(F.array_except("ids", a)) > 0)
    else:
        asked = candidates.select(X.clean(F.col("group")).alias("_of"), X.clean_id(F.col("id")).alias("_asked")).distinct()
        reviewed = reviewed.withColumn("_own", own(row_id)).withColumn("_group", text(group)).join(asked, (F.col("_group") == F.col("_of")) & (F.col("_own") == F.col("_asked")), "left")
        lists = F.bool_or(F.col("_asked").isNull() & (F.col("_group") != ""))
        foreign = F.col("allowed")
    g = reviewed.groupBy(key.alias("group_key"), text(canonical).alias("canonical")).agg(
        X.ordered_ids(F.collect_set(own(row_id))).alias("ids"),
        F.collect_set(own(representative)).alias("reps"),
        lists.alias("allowed"),
        F.bool_or(F.lower(text(flag)) == "yes").alias("any"),
    )
    rule = (
        F.when(foreign, F.lit("outside its candidate group"))
        .when(F.size("reps") != 1, F.lit("several representatives"))
        .when(~F.array_contains("ids", F.element_at("reps", 1)), F.lit("representative is no member"))
    )
    one = F.element_at(F.array_sort("reps"), 1)
    return g.select("group_key", "canonical", one.alias("representative"), F.array_join("ids", ";").alias("member_ids"), F.array_join(F.array_remove("ids", one), ";").alias("removed_ids"), F.size("ids").cast("long").alias("member_count"), F.when(F.col("any"), F.lit("yes")).otherwise(F.lit("no")).alias("flag"), rule.alias("rule"))
