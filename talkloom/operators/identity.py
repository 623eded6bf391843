"""Who is who: exact resolution, verdicts on senders, aliases, discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.functions import texts
from talkloom.operators import substrings
from talkloom.operators.normalize import contact_name
from talkloom.sources.scratch import kept


def query_namespace(query: Column) -> tuple[Column, Column]:
    """(namespace, value) of a query text: ``uid:``, ``uin:`` or ``name:`` say it, digits are a
    uin, ``u_`` begins a uid; anything else may be a uid or else a name (``auto``)."""
    text = F.trim(query)
    marked = F.regexp_extract(text, "^(uid|uin|name):", 1)
    value = F.when(marked != "", F.trim(F.regexp_replace(text, "^(uid|uin|name):", ""))).otherwise(text)
    kind = F.when(marked != "", marked).when(text.rlike("^[0-9]+$"), "uin").when(text.startswith("u_"), "uid").otherwise("auto")
    return kind, value


def resolve_contacts(queries: DataFrame, contacts: DataFrame) -> DataFrame:
    """``queries`` (query), ``contacts`` (uid, uin, nick, remark) -> (query, status, uid, uin).

    Exactly one distinct (uid, uin) must match; then neither of the two may be mapped to
    anything else by any contact.  Status: resolved, not_found, ambiguous, missing_uid,
    conflicting_mapping, invalid.
    """
    kind, value = query_namespace(F.col("query"))
    asked = queries.select("query", kind.alias("ns"), value.alias("value")).distinct()
    people = contacts.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("uid", "uin", "nick", "remark")]).distinct()
    # one row for each searchable value: joins are on equality only, never on OR
    keys = people.select(
        "uid", "uin",
        F.explode(F.array(
            F.struct(F.lit("uid").alias("ns"), F.col("uid").alias("value")), F.struct(F.lit("uin").alias("ns"), F.col("uin").alias("value")),
            F.struct(F.lit("name").alias("ns"), F.col("remark").alias("value")), F.struct(F.lit("name").alias("ns"), F.col("nick").alias("value")),
        )).alias("k"),
    ).select("uid", "uin", "k.ns", "k.value").filter("value <> ''").distinct()
    tries = asked.select(
        "query", "value", F.explode(F.when(F.col("ns") == "auto", F.array(F.lit("uid"), F.lit("name"))).otherwise(F.array("ns"))).alias("ns"), (F.col("ns") == "auto").alias("auto")
    )
    hits = tries.join(keys, ["ns", "value"])
    # names only count where no uid does
    first = Window.partitionBy("query")
    hits = hits.withColumn("by_uid", F.max(F.col("ns") == "uid").over(first)).filter(~F.col("auto") | ~F.col("by_uid") | (F.col("ns") == "uid"))
    one = hits.groupBy("query").agg(F.count_distinct("uid", "uin").alias("n"), F.min(F.struct("uid", "uin")).alias("who"))
    by_uid = people.filter("uid <> ''").groupBy("uid").agg(F.count_distinct("uin").alias("uins"))
    by_uin = people.filter("uin <> ''").groupBy("uin").agg(F.count_distinct("uid").alias("uids"))
    found = (
        asked.join(one, "query", "left").select("query", "value", "n", F.col("who.uid").alias("uid"), F.col("who.uin").alias("uin"))
        .join(by_uid, "uid", "left").join(by_uin, "uin", "left")
    )
    status = (
        F.when(F.col("value") == "", "invalid").when(F.col("n").isNull(), "not_found").when(F.col("n") > 1, "ambiguous")
        .when(F.col("uid") == "", "missing_uid").when((F.col("uins") > 1) | (F.col("uids") > 1), "conflicting_mapping").otherwise("resolved")
    )
    ok = status == "resolved"
    return found.select("query", status.alias("status"), F.when(ok, F.col("uid")).alias("uid"), F.when(ok, F.nullif("uin", F.lit(""))).alias("uin"))


def resolve_chats(queries: DataFrame, contacts: DataFrame, groups: DataFrame, discussions: DataFrame) -> DataFrame:
    """Exact ids or names as a private chat, else a group, else a discussion.

    ``groups`` and ``discussions``: (id, name).
    """
    private = resolve_contacts(queries, contacts).select("query", F.col("uid").alias("p"))

    def exact(dimension: DataFrame, name: str) -> DataFrame:
        keys = dimension.select(F.col("id").cast("string").alias("id"), F.explode(F.array(F.col("id").cast("string"), "name")).alias("query")).distinct()
        return queries.join(keys, "query").groupBy("query").agg(F.count_distinct("id").alias("n"), F.min("id").alias("id")).select("query", F.when(F.col("n") == 1, F.col("id")).alias(name))

    found = queries.distinct().join(private, "query", "left").join(exact(groups, "g"), "query", "left").join(exact(discussions, "d"), "query", "left")
    kind = F.when(F.col("p").isNotNull(), "private").when(F.col("g").isNotNull(), "group").when(F.col("d").isNotNull(), "discuss")
    return found.select("query", kind.alias("chat_type"), F.coalesce("p", "g", "d").alias("canonical_id"))


def sender_verdicts(rows: DataFrame, contacts: DataFrame, members: DataFrame, me_uid: str | None, me_uin: str | None) -> DataFrame:
    """Direction, sender name and warnings of raw rows (chat_type, chat_id, sender_uid, sender_uin).

    ``contacts`` (chat_id, uid, uin, name) of private chats, ``members`` (chat_id, uid, uin,
    name) of groups, one row each at most for a uid and for a uin.  A uid that matches with
    another uin, or the reverse, is a conflict; without a verified own identity no direction is
    known; else self, contact, member, and in groups anyone with an id.
    """
    uid, uin = texts.filled(F.col("sender_uid")), F.nullif(texts.filled(F.col("sender_uin")), F.lit("0"))
    base = rows.withColumn("__uid", uid).withColumn("__uin", uin)
    # two equality joins for the two keys, never one with OR
    by_uid = members.select("chat_id", F.col("uid").alias("__uid"), F.col("uin").alias("u_uin"), F.col("name").alias("u_name"))
    by_uin = members.select("chat_id", F.col("uin").alias("__uin"), F.col("uid").alias("n_uid"), F.col("name").alias("n_name"))
    peer = contacts.select("chat_id", F.col("uid").alias("c_uid"), F.col("uin").alias("c_uin"), F.col("name").alias("c_name"))
    joined = base.join(by_uid, ["chat_id", "__uid"], "left").join(by_uin, ["chat_id", "__uin"], "left").join(peer, "chat_id", "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    private = F.col("chat_type") == "private"
    my_uid, my_uin = (F.lit(x).cast("string") for x in (me_uid, me_uin))
    own, number = F.col("__uid"), F.col("__uin")

    def clash(known_uid: Column, known_uin: Column) -> Column:
        return yes((own == known_uid) & (number != known_uin)) | yes((number == known_uin) & (own != known_uid))

    conflict = (
        (F.lit(bool(me_uid)) & clash(my_uid, my_uin)) | (private & clash(F.col("c_uid"), F.col("c_uin")))
        | (~private & (yes(number != F.col("u_uin")) | yes(own != F.col("n_uid"))))
    )
    is_me = F.lit(bool(me_uid)) & (yes(own == my_uid) | yes(number == my_uin))
    is_peer = private & (yes(own == F.col("c_uid")) | yes(number == F.col("c_uin")))
    member = F.when(~private, F.coalesce(texts.filled(F.col("u_name")), texts.filled(F.col("n_name"))))
    is_member = ~private & (F.col("u_name").isNotNull() | F.col("n_name").isNotNull())
    some = F.coalesce(own, number)
    direction = (
        F.when(conflict | F.lit(not me_uid), "unknown").when(is_me, "from_me").when(is_peer, "from_contact")
        .when(is_member | (~private & some.isNotNull()), "from_member").otherwise("unknown")
    )
    name = (
        F.when(conflict | F.lit(not me_uid), F.coalesce(some, F.lit("unknown"))).when(is_me, "me").when(is_peer, F.col("c_name"))
        .when(is_member, F.coalesce(member, some)).otherwise(F.coalesce(some, F.lit("unknown")))
    )
    warnings = F.array_compact(F.array(F.when(conflict, F.lit("sender_identity_conflict")), F.when(~conflict & F.lit(not me_uid), F.lit("self_identity_unresolved"))))
    out = joined.withColumn("direction", direction).withColumn("sender", name).withColumn("warnings", warnings)
    return out.drop("__uid", "__uin", "u_uin", "u_name", "n_uid", "n_name", "c_uid", "c_uin", "c_name")


def canonical_chats(requests: DataFrame, chats: DataFrame) -> DataFrame:
    """``requests`` (requested) by the verified aliases of ``chats`` (canonical_id, aliases)."""
    alias = chats.select("canonical_id", F.explode(F.array_distinct(F.concat(F.array("canonical_id"), F.coalesce("aliases", F.array().cast("array<string>"))))).alias("requested"))
    found = requests.join(alias.distinct(), "requested", "left")
    return found.groupBy("requested").agg(F.when(F.count_distinct("canonical_id") == 1, F.min("canonical_id")).alias("canonical_id"))


def merged_identity(field: str, *aliases: Column) -> tuple[Column, Column]:
    """One value of several alias fields, and whether they contradict each other.

    Numbers are compared without leading zeros; a message id of zero is none at all.
    """
    def clean(c: Column) -> Column:
        text = F.nullif(c.cast("string"), F.lit(""))
        if field in ("message_id", "local_id", "timestamp"):
            text = F.when(text.rlike("^-?[0-9]{1,18}$"), text.try_cast("bigint").cast("string")).otherwise(text)
        return F.nullif(text, F.lit("0")) if field == "message_id" else text

    values = F.array_distinct(F.array_compact(F.array(*map(clean, aliases))))
    return F.when(F.size(values) == 1, F.get(values, F.lit(0))), F.size(values) > 1


def identity_complete(chat: Column, timestamp: Column, message_id: Column, local_id: Column) -> Column:
    return texts.filled(chat).isNotNull() & timestamp.isNotNull() & (message_id.isNotNull() | local_id.isNotNull())


def discover(queries: DataFrame, candidates: DataFrame, limit: int, names: tuple[str, ...] = ("remark", "nick"), others: tuple[str, ...] = ("uin", "uid"), key: str = "uid") -> DataFrame:
    """Ranked candidates that contain each query (query): exact values first, then names that
    contain it, then the rest; by display name within; one row for each key; ``complete`` says
    that no candidate is missing.  Wildcards in a query stand for themselves; blank ones find nothing.

    Both sides may be large: queries meet candidates by their rarest substrings.
    """
    if not 1 <= limit <= 100:
        raise ValueError("limit must be between 1 and 100")
    columns = [*names, *others]
    shown = contact_name(*[F.col(c) if c in candidates.columns else F.lit(None) for c in ("remark", "nick", "uin", "uid")]) if "display_name" not in candidates.columns else F.col("display_name")
    rows = kept(candidates.select(F.col(key).cast("string").alias("id"), shown.alias("display_name"), F.array(*[F.col(c).cast("string") for c in columns]).alias("values"), F.monotonically_increasing_id().alias("row")), "candidates")
    values = rows.select("row", F.posexplode("values").alias("column", "text")).filter("text <> ''").select(F.struct("row", "column").alias("id"), "text")
    found = substrings.find(queries.filter("trim(query) <> ''"), values)
    score = F.when(F.col("exact"), 0).when(F.col("id.column") < len(names), 1).otherwise(2)
    scored = found.select("query", F.col("id.row").alias("row"), score.alias("score")).join(rows.select("row", "id", "display_name"), "row")
    one = scored.groupBy("query", "id").agg(F.min(F.struct("score", "display_name")).alias("b")).select("query", "id", "b.*")
    return substrings.best(kept(one, "matches"), limit, ["score", "display_name", "id"])


def discover_everywhere(queries: DataFrame, sources: dict[str, DataFrame], limit: int) -> tuple[DataFrame, DataFrame]:
    """The same over several sources: candidates with their source, and each source's status.

    A source without the needed columns fails alone; the others answer.
    """
    spark = queries.sparkSession
    out, statuses = None, []
    for name, candidates in sources.items():
        ok = all(c in candidates.columns for c in ("uid", "uin", "nick", "remark"))
        statuses.append((name, ok))
        if ok:
            part = discover(queries, candidates, limit).withColumn("source", F.lit(name))
            out = part if out is None else out.unionByName(part)
    return out, spark.createDataFrame(statuses, "source string, ok boolean")
