"""Schemas that drift between files: rescue-column ingestion and a change report.

Raw JSON records are read against a fixed target schema. What the schema does
not know, or cannot cast, is kept per record as one JSON object (the rescue
column). Fields that are later approved, under whatever name they came, are
replayed from the rescue column into typed columns. JSON is parsed once per
record by the variant parser inside the JVM; while records pass from one step to
the next, the rescue column is kept as parsed leaves and written as JSON only at
the end. No Python runs per record.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Target schema of a trip record: column -> type. The two fees are promoted from the rescue column.
TRIP_SCHEMA: dict[str, str] = {
    "hvfhs_license_num": "string",
    "dispatching_base_num": "string",
    "pickup_datetime": "timestamp_ntz",
    "PULocationID": "int",
    "DOLocationID": "int",
    "trip_miles": "double",
    "trip_time": "bigint",
    "base_passenger_fare": "double",
    "congestion_surcharge": "double",
    "driver_pay": "double",
}

#: Approved fields: a field is carried by a key path whose normalised words match the first pattern and not the second.
#: Words are lower case, joined and enclosed by ``_``.
APPROVED: dict[str, tuple[str, str]] = {
    "airport_fee": (
        r"^(?=.*_(airport|airports|apt|arpt)_)(?=.*_(fee|fees|charge|charges|surcharge|surcharges|amount|amt|usd|toll|tax)_)",
        r"_(code|codes|note|notes|name|flag|id|zone|comment|count)_([0-9]+_|v[0-9]+_)?$",
    ),
    "cbd_congestion_fee": (
        r"^(?=.*(_cbd_|_central_(business_)?district_))(?=.*_(fee|fees|charge|charges|surcharge|surcharges|amount|amt|usd|toll|tax|relief|congestion)_)",
        r"_(code|codes|note|notes|name|flag|id|zone|comment|count)_([0-9]+_|v[0-9]+_)?$",
    ),
}

AGAIN = "\x1f"  # parts a repeated path from its place
NUMBER_TYPES = ("BIG", "INT", "SMA", "TIN", "DOU", "FLO", "DEC")


PART = "\x1e"  # parts the paths of a record while their words are found together


def words_of(paths: Column) -> Column:
    """Key paths (array) as ``_word_word_`` each: camel case, capitals, blanks, dots and dashes all separate alike.

    The paths of a record are joined for it, so that each expression runs once a record.
    """
    joined = F.array_join(F.transform(paths, lambda p: F.concat(F.lit("_"), F.translate(p, PART, " "), F.lit("_"))), PART)
    spaced = F.regexp_replace(joined, r"(\p{Ll}|\p{Nd})(?=\p{Lu})|(\p{Lu})(?=\p{Lu}\p{Ll})", "$1$2_")
    return F.split(F.regexp_replace(F.lower(spaced), rf"[^\p{{L}}\p{{Nd}}{PART}]+", "_"), PART)


def carried_fields(paths: Column, approved: Mapping[str, tuple[str, str]] = APPROVED) -> Column:
    """The approved field that each key path of an array carries, or null."""

    def field_of(words: Column) -> Column:
        found = F.lit(None).cast("string")
        for field, (must, never) in approved.items():
            found = F.when(words.rlike(must) & ~words.rlike(never), F.lit(field)).otherwise(found)
        return found

    return F.when(F.size(paths) > 0, F.transform(words_of(paths), field_of)).otherwise(F.array().cast("array<string>"))


def carried_field(path: Column, approved: Mapping[str, tuple[str, str]] = APPROVED) -> Column:
    """The approved field that a key path carries, or null."""
    return F.get(carried_fields(F.array(path), approved), F.lit(0))


LEAF = "struct<key:string,value:variant,t:string>"  # t: the variant's schema; of a scalar, its type


def leaves_sql(source: str, payload: str) -> str:
    """SQL for an array of ``LEAF`` of the variant column ``source``, parsed from ``payload``.

    Members of nested objects come under dotted paths, those of arrays that hold
    objects (or differ in type) under ``path[i]``; other arrays and empty objects
    are values. Levels are opened until none is left: each takes a bracket of the
    payload. Null where ``source`` is no object.
    """
    leaf = lambda key, value: f"struct({key} as key, {value} as value, schema_of_variant({value}) as t)"
    members = f"map_entries(try_cast({source} as map<string,variant>))"
    is_object, is_array = "(e.t like 'OBJECT<_%' and e.t <> 'OBJECT<>')", "(e.t like 'ARRAY<%OBJECT<%' or e.t like 'ARRAY<%VARIANT%')"
    inside = (
        f"flatten(transform(s, e -> case when {is_object} then transform(map_entries(try_cast(e.value as map<string,variant>)), m -> {leaf("e.key||'.'||m.key", 'm.value')}) "
        f"when {is_array} then transform(try_cast(e.value as array<variant>), (v, i) -> {leaf("e.key||'['||i||']'", 'v')}) else array(e) end))"
    )
    levels = f"length({payload}) - length(translate({payload}, '{{[', '')) - 1"
    nested = f"(locate('{{', {payload}, locate('{{', {payload}) + 1) > 0 or contains({payload}, '['))"  # most records are flat
    steps = f"if({nested}, sequence(1, greatest(1, {levels})), cast(array() as array<int>))"
    return f"reduce({steps}, cast(transform({members}, m -> {leaf('m.key', 'm.value')}) as array<{LEAF}>), (s, n) -> if(exists(s, e -> {is_object} or {is_array}), cast({inside} as array<{LEAF}>), s))"


def with_leaves(rows: DataFrame, payload: str = "payload", name: str = "_leaves") -> DataFrame:
    """``rows`` with the leaves of each JSON payload, and the parsed payload as ``_parsed``.

    The leaves are null for a null or cut-off payload, JSON that is no object,
    and an object that repeats a key: such a record is not readable. Where a
    dotted key spells another leaf's path, the later one gets ``AGAIN`` and its
    place.
    """
    parsed = rows.withColumn("_parsed", F.try_parse_json(F.col(payload)))
    unique = f"if(size(array_distinct({name}.key)) = size({name}), {name}, transform({name}, (e, i) -> struct(e.key || if(array_position({name}.key, e.key) = i + 1, '', '{AGAIN}' || i) as key, e.value as value, e.t as t)))"
    return parsed.withColumn(name, F.expr(leaves_sql("_parsed", payload))).withColumn(name, F.expr(unique))


def json_kind(short: Column) -> Column:
    """JSON type from the first three letters of a variant's schema: number, string, boolean, null, object or array."""
    return (
        F.when(short.isin(*NUMBER_TYPES), "number").when(short == "STR", "string").when(short == "BOO", "boolean")
        .when(short == "VOI", "null").when(short == "OBJ", "object").otherwise("array")
    )


def replayed(rescued: str = "rescued") -> Column:
    """The leaves that a rescue column holds as JSON."""
    return F.expr(f"transform(map_entries(try_cast(try_parse_json({rescued}) as map<string,variant>)), m -> struct(m.key as key, m.value as value, schema_of_variant(m.value) as t))")


def key_inventory(table: DataFrame, by: str = "file_id") -> DataFrame:
    """``by``, ``key``, ``kind``, ``n``: how often each key path is among the rescued leaves of ingested records with each JSON type. Mergeable by addition."""
    held = F.col("rescued") if table.schema["rescued"].dataType.typeName() == "array" else F.when(F.col("readable"), replayed())
    leaves = table.select(F.col(by), F.explode_outer(held).alias("_leaf"))
    short = F.substring("_leaf.t", 1, 3)
    counted = leaves.select(by, F.col("_leaf.key").alias("key"), short.alias("_t")).groupBy(by, "key", "_t").agg(F.count(F.lit(1)).alias("n")).where("key is not null")
    key = F.regexp_replace(F.regexp_replace("key", f"{AGAIN}[0-9]+$", ""), r"\[[0-9]+\]", "[]").alias("key")  # an item's place is no part of its path
    return counted.select(by, key, json_kind(F.col("_t")).alias("kind"), "n").groupBy(by, "key", "kind").agg(F.sum("n").alias("n"))


def typed_inventory(table: DataFrame, schema: Mapping[str, str] = TRIP_SCHEMA, by: str = "file_id") -> DataFrame:
    """``by``, ``key``, ``kind``, ``n`` as :func:`key_inventory`, of the values that the typed columns of ingested records hold."""
    counts = table.groupBy(by).agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(schema)])
    kind = lambda t: "number" if t in NUMBER_TARGETS else "boolean" if t == "boolean" else "string"
    rows = F.array(*[F.struct(F.lit(c).alias("key"), F.lit(kind(t)).alias("kind"), F.col(f"_n{i}").alias("n")) for i, (c, t) in enumerate(schema.items())])
    return counts.select(by, F.inline(rows)).where("n > 0")


def field_states(inventory: DataFrame, approved: Mapping[str, tuple[str, str]] = APPROVED, by: str = "file_id", others: bool = False) -> DataFrame:
    """Of an inventory ``by``, ``field``, ``keys`` (sorted set of the carrying paths), ``kind`` of most non-null values.

    ``others`` also takes every key that carries no approved field, as a field of
    its own name. A tie between types goes to the first by name; a file whose
    values are all null has no kind. A few rows per file, whatever the file's
    size: the key counts are partially aggregated beside the scan.
    """
    # tied to the count, so that the filter isn't pushed below the aggregate and tried on every leaf of every record
    field = F.when(F.col("n") > 0, carried_field(F.col("key"), approved))
    carried = inventory.withColumn("field", F.coalesce(field, F.col("key")) if others else field).where(F.col("field").isNotNull())
    per_kind = carried.groupBy(by, "field", "kind").agg(F.sum("n").alias("n"), F.collect_set("key").alias("keys"))
    value_kind = F.col("kind").isin("number", "string", "boolean")
    return per_kind.groupBy(by, "field").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys"),
        F.max_by(F.when(value_kind, F.col("kind")), F.when(value_kind, F.struct(F.col("n"), F.element_at(F.create_map(F.lit("boolean"), F.lit(3), F.lit("number"), F.lit(2), F.lit("string"), F.lit(1)), F.col("kind"))))).alias("kind"),
    )


def drift_report(rows: DataFrame, manifest: DataFrame, approved: Mapping[str, tuple[str, str]] = APPROVED, schema: Mapping[str, str] = TRIP_SCHEMA, every_key: bool = False) -> DataFrame:
    """``file_id``, ``field``, ``change``, ``before``, ``after``: each file of ``rows`` against the file before it in its feed.

    ``manifest`` has ``file_id``, ``feed``, ``file_seq``. Changes are added,
    removed, renamed and retyped; a file can have two of one field, and the
    first file of a feed has none. A file without one readable record holds
    nothing. Files absent from ``rows`` or the manifest are not compared.

    The records are ingested; the approved fields are read from the rescued
    leaves, as :func:`promote` replays them. With ``every_key`` all other keys
    are reported too, from the typed columns and the rescued leaves: a typed
    column is held if it has a value, or its key was rescued because most of its
    values no longer fit. The windows run over files, not records, and are
    partitioned by feed and field.
    """
    table = ingest(rows.select("file_id", "payload"), schema, "payload", False)
    inventory = key_inventory(table)
    if every_key:
        inventory = inventory.unionByName(typed_inventory(table, schema))
    states = field_states(inventory, approved, others=every_key)
    files = rows.select("file_id").distinct().join(manifest.select("file_id", "feed", "file_seq"), "file_id")
    if every_key:  # the fields of a feed are those of any of its files
        fields = files.join(states.select("file_id", "field"), "file_id").select("feed", "field").distinct()
        pairs = files.join(fields, "feed")
    else:
        pairs = files.select("*", F.explode(F.array(*[F.lit(f) for f in approved])).alias("field"))
    order = Window.partitionBy("feed", "field").orderBy("file_seq")
    pairs = pairs.join(states, ["file_id", "field"], "left").withColumn("held", F.col("keys").isNotNull())
    for c in ("held", "keys", "kind"):
        pairs = pairs.withColumn(f"_{c}", F.lag(c).over(order))
    text = lambda c: F.array_join(F.col(c), ", ")
    both = F.col("held") & F.col("_held")
    change = lambda when, name, before, after: F.when(when, F.struct(F.lit(name).alias("change"), before.alias("before"), after.alias("after")))
    changes = F.array(
        change(F.col("held") & ~F.col("_held"), "added", text("_keys"), text("keys")),
        change(~F.col("held") & F.col("_held"), "removed", text("_keys"), text("keys")),
        change(both & (F.col("keys") != F.col("_keys")), "renamed", text("_keys"), text("keys")),
        change(both & (F.col("kind") != F.col("_kind")), "retyped", F.col("_kind"), F.col("kind")),
    )
    return (
        pairs.where(F.col("_held").isNotNull())
        .select("file_id", "field", F.explode(F.array_compact(changes)).alias("_c"))
        .select("file_id", "field", "_c.change", "_c.before", "_c.after")
    )


def amounts(texts: Column) -> Column:
    """Numbers from an array of texts such as ``2.5``, `` 2.5 ``, ``$2.50``, ``USD 2.5``, ``2,50``, ``1,250.00 usd``; null for anything else."""
    bare = F.transform(texts, lambda x: F.regexp_replace(F.lower(F.trim(x)), r"^(usd|us\$|\$|€|eur)\s*|\s*(usd|us\$|\$|€|eur)$", ""))
    grouped = F.transform(bare, lambda x: F.when(~x.contains(","), x).when(x.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?$"), F.replace(x, F.lit(","))).otherwise(F.regexp_replace(x, r"^([+-]?\d+),(\d+)$", "$1.$2")))
    return F.transform(grouped, lambda x: F.when(x.rlike(r"^[+-]?(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?$"), x.try_cast("double")))


def amount(text: Column) -> Column:
    """A number from text, as in :func:`amounts`."""
    return F.get(amounts(F.array(text)), F.lit(0))


NUMBER_TARGETS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _fitting(column: str, kind: str) -> str:
    """SQL of a top-level key's value ``_v`` of type ``_t`` in the type of its column, null unless the JSON type fits and nothing is lost by the cast."""
    v, t = f"_v.`{column}`", f"_t.`{column}`"
    value = f"try_variant_get({v}, '$', '{kind}')"
    number = f"left({t}, 3) in ({', '.join(repr(n) for n in NUMBER_TYPES)})"
    if kind in ("float", "double"):
        digits = f"cast(substring_index(substring_index({t}, '(', -1), ',', 1) as int)"
        exact = f"case left({t}, 3) when 'BIG' then cast({value} as bigint) = try_variant_get({v}, '$', 'bigint') when 'DEC' then {digits} <= {15 if kind == 'double' else 6} else true end"
        return f"if({number} and {exact}, {value}, null)"
    if kind in NUMBER_TARGETS:
        return f"if({number}, if({t} = 'BIGINT' or cast({value} as double) = try_variant_get({v}, '$', 'double'), {value}, null), null)"
    return f"if({t} = '{'BOOLEAN' if kind == 'boolean' else 'STRING'}', {value}, null)"


def _as_json(leaves: Column) -> Column:
    return F.when(F.size(leaves) > 0, F.to_json(F.map_from_entries(F.transform(leaves, lambda e: F.struct(e["key"], e["value"])))))


def ingest(rows: DataFrame, schema: Mapping[str, str] = TRIP_SCHEMA, payload: str = "payload", as_json: bool = True) -> DataFrame:
    """``rows`` without the payload, with the typed columns of ``schema``, ``readable`` and ``rescued``.

    A key of exactly a schema name goes to its column if its JSON type fits (a
    number to a number, text to text or a time) and the column's type holds the
    value without loss: 3.7 is no int, ``true`` no number, ``"3"`` no int. Every
    other leaf (unknown key, value that doesn't fit) is kept in ``rescued``, a
    JSON object of key paths, which is null when nothing is left over. A record
    that isn't readable has null columns and its raw text under ``_unreadable``.
    A typed column takes the place of an input column of the same name. Without
    ``as_json`` the rescued leaves stay parsed (array of ``LEAF``) for a next
    step, null for a record that isn't readable.
    """
    leaves = with_leaves(rows.drop(*schema, "readable", "rescued"), payload)
    names = ", ".join(f"`{c}`: variant" for c in schema)
    typed = leaves.withColumn("_v", F.expr(f"try_variant_get(_parsed, '$', 'struct<{names}>')") if schema else F.lit(None))
    typed = typed.withColumn("_t", F.struct(F.lit(0).alias("_"), *[F.expr(f"schema_of_variant(_v.`{c}`)").alias(c) for c in schema]))
    typed = typed.withColumns({c: F.expr(_fitting(c, kind)) for c, kind in schema.items()})
    taken = " ".join(f"when '{c}' then {c} is not null or e.t = 'VOID'" for c in schema)
    left = F.expr(f"filter(_leaves, e -> not (case e.key {taken} else false end))" if schema else "_leaves")
    unreadable = F.when(F.col("_leaves").isNull() & F.col(payload).isNotNull(), F.to_json(F.struct(F.col(payload).alias("_unreadable"))))
    out = typed.withColumn("readable", F.col("_leaves").isNotNull()).withColumn("rescued", left)
    if as_json:
        return out.withColumn("rescued", unreadable.otherwise(_as_json(F.col("rescued")))).drop("_parsed", "_leaves", "_v", "_t", payload)
    return out.withColumn("_unreadable", unreadable).drop("_parsed", "_leaves", "_v", "_t", payload)


def promote(table: DataFrame, approved: Mapping[str, tuple[str, str]] = APPROVED) -> DataFrame:
    """Replays rescued values into one double column per approved field.

    Of a record's leaves that carry the field, the first (by key path) whose
    value is a number, or text that :func:`amount` reads, is taken and leaves
    ``rescued``; a null value leaves it too. Booleans and other text tell no
    amount, so they stay rescued and the column is null. ``table`` may hold the
    rescued leaves as JSON or, straight from :func:`ingest`, parsed.
    """
    parsed = table.schema["rescued"].dataType.typeName() == "array"
    out = table.drop(*approved).withColumn("_left", F.col("rescued") if parsed else replayed())
    out = out.withColumn("_left", F.expr("array_sort(_left, (a, b) -> case when a.key < b.key then -1 when a.key > b.key then 1 else 0 end)"))
    out = out.withColumn("_names", carried_fields(F.transform("_left", lambda e: e["key"]), approved))
    # only the value of a carrying leaf is read, and only text is searched for a number
    out = out.withColumn("_texts", F.expr("transform(_left, (e, i) -> if(_names[i] is not null and e.t = 'STRING', try_cast(e.value as string), null))"))
    out = out.withColumn("_texts", F.when(F.exists("_texts", lambda x: x.isNotNull()), amounts(F.col("_texts"))))
    out = out.withColumn("_values", F.expr(f"transform(_left, (e, i) -> if(_names[i] is not null and left(e.t, 3) in ({', '.join(repr(n) for n in NUMBER_TYPES)}), try_cast(e.value as double), _texts[i]))"))
    for field in approved:
        out = out.withColumn(field, F.expr(f"get(filter(_values, (x, i) -> x is not null and _names[i] = '{field}'), 0)"))
    unused = F.expr("filter(_left, (e, i) -> not coalesce(_names[i] is not null and (_values[i] is not null or e.t = 'VOID'), false))")
    carried = F.exists("_names", lambda x: x.isNotNull())
    out = out.withColumn("_left", F.when(carried, unused).otherwise(F.col("_left"))).withColumn("_changed", carried)
    unread = F.col("_unreadable") if parsed else F.col("rescued")
    rescued = F.when(F.col("_left").isNull(), unread).otherwise(_as_json(F.col("_left")) if parsed else F.when(F.col("_changed"), _as_json(F.col("_left"))).otherwise(F.col("rescued")))
    return out.withColumn("rescued", rescued).drop("_left", "_names", "_texts", "_values", "_changed", "_unreadable")
