"""Near-duplicates by a signature-coordinate inverted join.

A text's set of word shingles gives a MinHash signature of ``coords`` values.
Documents are posted under each pair of a coordinate and its value, and two
documents that agree in at least ``matches`` coordinates are candidates:

* prefix: with the pairs of a document in order of their number of postings,
  rarest first, two such documents share one of their first
  ``coords - matches + 1`` pairs, so only those are posted for the join.
  Pairs that only one document has are in no posting list; a document with
  fewer than ``matches`` shared ones is in none at all;
* skip: collisions are counted on the two signatures, after the ratio of the
  set sizes has ruled out what cannot be similar.

Links are confirmed on full sets.  Documents with equal sets form one class,
and only a class's smallest id takes part.  In each of three turns every class is
compared with one hub of its lists, first the one that agrees most with all others,
and links found are contracted.  What then still belongs to different components is
compared, all of it: the members outside a list's largest component meet the whole
list.  Before, every document leaves that has fewer than ``matches`` pairs which
different components hold, as do those of one frequent passage.  A list that still has
more than ``DIRECT`` members is not expanded: its members' full sets are listed by
shingle, those that share too little with other components leave, and the others meet
under their rarest shingles only, in bands of sizes.  No pair of similar sets is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm.components import components
from aerolake.llm.planes import text_slices
from aerolake.llm.shingles import mix, shingle_set, slice_words
from aerolake.llm.store import materialise, run_folder

DIRECT = 8  # members of a list that are compared without their full sets
BAND = 1.05  # ratio of the sizes of full sets in a band
SIGNED = "id long, n_shingles long, key_a long, key_b long, signature array<int>"


def signature(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The least 32-bit hash of the set under each of the seeds."""
    least = np.full(len(seeds), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), 2048):
        hashed = (shingles[at:at + 2048, None] * seeds) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=0))
    return least.astype(np.uint32).view(np.int32)


def seeds(coords: int) -> np.ndarray:
    """Odd multipliers, one for each coordinate."""
    return mix(np.arange(1, coords + 1, dtype=np.uint64) << np.uint64(7)) | np.uint64(1)


def signatures(docs: DataFrame, id_column: str, text_column: str, coords: int,
               width: int) -> DataFrame:
    """Set size, a 128-bit key of the set and the signature of each text."""
    def sign(batches):
        salts = seeds(coords)
        for ids, texts in text_slices(batches):
            sets = [shingle_set(w, width)
                    for w in slice_words([(t or "").encode() for t in texts])]
            other = [mix(s + np.uint64(0x51ED270B27C3D1E9)) for s in sets]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([int(s.sum().view(np.int64)) for s in sets], pa.int64()),
                pa.array([int(o.sum().view(np.int64)) for o in other], pa.int64()),
                pa.array([signature(s, salts) if len(s) else [] for s in sets],
                         pa.list_(pa.int32()))],
                names=["id", "n_shingles", "key_a", "key_b", "signature"])

    return docs.select(F.col(id_column).cast("long"), text_column).mapInArrow(sign, SIGNED)


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full shingle sets are similar enough."""
    def confirm(batches):
        last, kept = None, None
        for batch in batches:
            good = []
            for a, b, text_a, text_b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                left, right = (shingle_set(w, width) for w in slice_words([text_a, text_b]))
                both = len(np.intersect1d(left, right, assume_unique=True))
                good.append(100 * both >= percent * (len(left) + len(right) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    first = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return (pairs.join(first, "a").join(second, "b")
            .select("a", "b", F.encode("text_a", "UTF-8"), F.encode("text_b", "UTF-8"))
            .mapInArrow(confirm, "a long, b long"))


def near_duplicates(docs: DataFrame, folder: str, id_column: str = "doc_id",
                    text_column: str = "text", coords: int = 64, matches: int = 33,
                    width: int = 5, percent: int = 75) -> DataFrame:
    """``id``, ``n_shingles``, ``component`` (smallest id reachable by links,
    itself included) of each id in ``docs``.

    Two texts are linked if 100 * intersection >= ``percent`` * union of their
    shingle sets; texts without words are linked with nothing.  A link of
    similarity s is missed if fewer than ``matches`` of ``coords``
    coordinates agree, a binomial tail: 3e-5 at s = 0.75 by the defaults, and
    falling fast above.  Repeated rows count once; rows that share an id but
    not a text are one document that has the links of all its texts.  Rows
    without an id have their size and no component.  Other columns are ignored.
    """
    signed = materialise(signatures(docs, id_column, text_column, coords, width),
                         f"{folder}/signed")
    named = signed.filter("id is not null")
    full = named.filter("n_shingles > 0")
    key = ["key_a", "key_b", "n_shingles"]
    classes = materialise(full.groupBy(*key).agg(F.min("id").alias("class")),
                          f"{folder}/classes")
    members = materialise(
        full.select("id", *key).join(classes, key).select("id", "class").filter("id <> class")
        .distinct(), f"{folder}/members")
    # A class's representative: one row for each class and its own set.
    stands = materialise(
        full.join(classes.withColumnRenamed("class", "id"), ["id", *key], "left_semi")
        .select("id", *key, "signature").dropDuplicates(["id", *key])
        .select(F.xxhash64("id", *key).alias("slot"), "id", "n_shingles", "signature"),
        f"{folder}/stands")

    posted = postings(stands, "slot", name="key")
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    ranked = (posted.join(shared, "key").groupBy("slot")
              .agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
              .filter(F.size("keys") >= matches))
    prefix = materialise(
        ranked.select("slot", F.expr("aggregate(keys, 0L, (s, k) -> s + k.n)").alias("met"),
                      F.explode(F.expr(f"slice(keys, 1, size(keys) - {matches - 1})")).alias("k"))
        .select("slot", "met", "k.key"), f"{folder}/prefix")

    about = stands.select("slot", "id", "n_shingles", "signature")
    words = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column)
                        .alias("text"))

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """Slots (a, b) of ``pairs`` that are linked."""
        one, two = (about.select(F.col("slot").alias(s), F.col("n_shingles").alias(f"n_{s}"),
                                 F.col("signature").alias(f"s_{s}")) for s in "ab")
        alike = F.aggregate(F.zip_with("s_a", "s_b", lambda x, y: (x == y).cast("int")),
                            F.lit(0), lambda n, x: n + x)
        likely = materialise(
            pairs.join(one, "a").join(two, "b")
            .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            .filter(alike >= matches).select("a", "b"), f"{folder}/likely-{name}")
        asked = likely.select(F.explode(F.array("a", "b")).alias("slot")).distinct()
        texts = slot_texts(words, about.join(asked, "slot", "left_semi"))
        return materialise(confirmed(likely, texts, width, percent), f"{folder}/links-{name}")

    # Hubs: whoever agrees most with all others, then the largest and the least hash.
    found, labels = None, None
    for turn, rank in enumerate(("met", "slot", "~slot")):
        best = F.struct(F.expr(rank).alias("rank"), "slot")
        hubs = prefix.groupBy("key").agg(F.max(best).alias("best"))
        pairs = (prefix.join(hubs, "key").filter("slot <> best.slot")
                 .groupBy("slot").agg(F.max("best").alias("best")))
        pairs = pairs.select(F.col("slot").alias("a"), F.col("best.slot").alias("b"))
        if labels is not None:
            pairs = _apart(pairs, labels)
        new = links(pairs, f"hub-{turn}")
        found = new if found is None else found.unionAll(new)
        labels = components(found, f"{folder}/hub-{turn}")

    # What is left: members of one list in different components.
    lists = materialise(unsettled(_labelled(prefix, labels, "slot", "comp"), ["key"])
                        .select("key", "slot", "comp"), f"{folder}/lists")
    alive = partners(lists.select("slot", "comp").distinct(), stands.select("slot", "signature"),
                     matches, f"{folder}/alive")
    left = materialise(unsettled(lists.join(alive, "slot", "left_semi"), ["key"]),
                       f"{folder}/left")
    pairs = across(left.filter(F.col("size") <= DIRECT), ["key"])
    wide = left.filter(F.col("size") > DIRECT).select("slot", "comp").distinct()
    texts = slot_texts(words, about.join(wide, "slot", "left_semi"))
    parts = set_lists(full_sets(texts, width).join(wide, "slot"), percent, f"{folder}/sets")
    pairs = pairs.unionAll(similar(parts)).distinct()
    found = found.unionAll(links(pairs, "rest"))

    # Links between slots become links between ids; members and shared ids join in.
    name = about.select("slot", "id")
    edges = (found.join(name.select(F.col("slot").alias("a"), F.col("id").alias("ia")), "a")
             .join(name.select(F.col("slot").alias("b"), F.col("id").alias("ib")), "b")
             .select(F.col("ia").alias("a"), F.col("ib").alias("b"))
             .unionAll(members.select(F.col("id").alias("a"), F.col("class").alias("b"))))
    final = components(edges, f"{folder}/final")
    sizes = named.groupBy("id").agg(F.max("n_shingles").alias("n_shingles"))
    result = _labelled(sizes, final, "id", "component")
    return result.unionByName(signed.filter("id is null").select(
        "id", "n_shingles", F.lit(None).cast("long").alias("component")))


def postings(rows: DataFrame, *columns: str, name: str) -> DataFrame:
    """``columns`` and each pair of a coordinate and its value, as one long."""
    return rows.select(*columns, F.posexplode("signature").alias("_at", "_value")).select(
        *columns, F.shiftleft(F.col("_at").cast("long"), 32)
        .bitwiseOR(F.col("_value").cast("long").bitwiseAND(0xFFFFFFFF)).alias(name))


def unsettled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows (keys, slot, comp) of lists with members of different components,
    with the list's ``largest`` component and its ``size``."""
    parts = rows.groupBy(*keys, "comp").agg(F.count("*").alias("n"))
    lists = parts.groupBy(*keys).agg(
        F.count("*").alias("parts"), F.sum("n").alias("size"),
        F.min_by("comp", F.struct(-F.col("n"), "comp")).alias("largest")).filter("parts > 1")
    return rows.join(lists.drop("parts"), keys)


def across(left: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs (a, b) of slots in different components of a list."""
    minor = left.filter("comp <> largest").select(
        *keys, F.col("slot").alias("x"), F.col("comp").alias("comp_x"))
    return (left.select(*keys, F.col("slot").alias("y"), F.col("comp").alias("comp_y"))
            .join(minor, keys).filter("comp_x <> comp_y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")))


def partners(members: DataFrame, signed: DataFrame, matches: int, folder: str) -> DataFrame:
    """The slots of ``members`` (slot, comp) that may agree in ``matches`` coordinates
    with a member of another component: so many of their values are held by more than
    one component.  Counted twice, as those that leave take their values along."""
    posted = postings(members.join(signed, "slot"), "slot", "comp", name="other")
    for turn in range(2):
        held = (posted.groupBy("other").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .filter("lo <> hi").select("other"))
        alive = materialise(posted.join(held, "other").groupBy("slot")
                            .agg(F.count("*").alias("n")).filter(F.col("n") >= matches)
                            .select("slot"), f"{folder}/{turn}")
        posted = posted.join(alive, "slot", "left_semi")
    return alive


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """``slot``, ``own`` (a key of the set), its size ``n`` and each ``shingle`` of the
    texts (id: slot, text)."""
    def spread(batches):
        for ids, rows in text_slices(batches):
            for slot, ws in zip(ids, slice_words([(t or "").encode() for t in rows])):
                found = shingle_set(ws, width)
                for at in range(0, len(found), 1 << 16):
                    part = found[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(part), slot)),
                        pa.array(np.full(len(part), found.sum().view(np.int64))),
                        pa.array(np.full(len(part), len(found))), pa.array(part.view(np.int64))],
                        names=["slot", "own", "n", "shingle"])

    return texts.dropDuplicates(["id", "text"]).select("id", "text").mapInArrow(
        spread, "slot long, own long, n long, shingle long")


def set_lists(rows: DataFrame, percent: int, folder: str) -> DataFrame:
    """Lists by shingle of the sets (slot, own, n, shingle, comp): any two similar sets of
    different components meet in a list (shingle, low, high).

    Similar sets share at least ``percent`` of each, so a set with fewer shingles that
    different components hold leaves.  With a set's shingles in order of the number of sets
    that hold them, rarest first, sets of n and m shingles share one of the first
    n - o + 1 and m - o + 1, o = (n + m) * percent / (100 + percent) being the least
    overlap.  ``top`` is the largest m for which a shingle is among these; a set is listed
    once for each ``band`` of sizes ``other`` up to there.
    """
    for turn in range(2):
        held = (rows.groupBy("shingle")
                .agg(F.count("*").alias("f"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .filter("lo <> hi").select("shingle", "f"))
        ranked = materialise(
            rows.join(held, "shingle").groupBy("slot", "comp", "own", "n")
            .agg(F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("held"))
            .filter(F.size("held") * 100 >= F.col("n") * percent), f"{folder}/{turn}")
        rows = ranked.select("slot", "comp", "own", "n", F.explode("held.shingle").alias("shingle"))
    # A place in the whole order: shingles of one component alone come first.
    first = ranked.withColumn("gone", F.col("n") - F.size("held")).select(
        "slot", "comp", "n", "gone", F.posexplode(F.expr(
            f"slice(held, 1, int(n * {100 - percent} div 100 - gone + 1))")).alias("at", "h"))
    posted = first.select("slot", "comp", "n", "h.shingle", F.expr(
        f"least((n - gone - at) * {100 + percent} div {percent} - n, n * 100 div {percent})")
        .alias("top"))

    def band(size):
        return F.floor(F.log(size) / float(np.log(BAND)) + 1e-9).cast("int")

    least = F.floor((F.col("n") * percent + 99) / 100)
    return unsettled(
        posted.filter(F.col("top") >= least)
        .withColumns({"band": band(F.col("n")), "other": F.explode(F.sequence(
            band(least), band(F.col("top"))))})
        .withColumns({"low": F.least("band", "other"), "high": F.greatest("band", "other")}),
        ["shingle", "low", "high"])


def similar(left: DataFrame) -> DataFrame:
    """Pairs (a, b) of slots in different components of the ``set_lists`` whose sizes and
    places allow them to be similar."""
    minor = left.filter("comp <> largest").select(
        "shingle", F.col("other").alias("band"), F.col("band").alias("other"),
        *(F.col(c).alias(f"{c}_x") for c in ("slot", "comp", "n", "top")))
    return (left.select("shingle", "band", "other", "slot", "comp", "n", "top")
            .join(minor, ["shingle", "band", "other"])
            .filter("comp <> comp_x and n <= top_x and n_x <= top")
            .select(F.greatest("slot", "slot_x").alias("a"), F.least("slot", "slot_x").alias("b")))


def split_lists(rows: DataFrame, signed: DataFrame, matches: int, folder: str) -> DataFrame:
    """The lists (key, slot, comp) by a second pair ``other``: any two members of
    different components that agree in ``matches`` coordinates meet in one part."""
    posted = postings(rows.join(signed, "slot"), "key", "slot", "comp", name="other").filter(
        "other <> key")
    for turn in range(2):
        # Only a pair that different components hold can be a match of theirs.
        held = (posted.groupBy("key", "other")
                .agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                .filter("lo <> hi"))
        ranked = materialise(
            posted.join(held.select("key", "other", "n"), ["key", "other"])
            .groupBy("key", "slot", "comp")
            .agg(F.sort_array(F.collect_list(F.struct("n", "other"))).alias("others"))
            .filter(F.size("others") >= matches - 1), f"{folder}/{turn}")
        posted = ranked.select("key", "slot", "comp", F.explode("others.other").alias("other"))
    return ranked.select("key", "slot", "comp", F.explode(
        F.expr(f"slice(others, 1, size(others) - {matches - 2})")).alias("o")).select(
            "key", "slot", "comp", "o.other")


def slot_texts(words: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id: slot, text): the texts of the wanted slots' documents."""
    return (words.join(wanted.select("id", "slot"), "id")
            .select(F.col("slot").alias("id"), F.coalesce("text", F.lit("")).alias("text")))


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with the component of the id in ``column``: itself if none."""
    return (rows.join(labels.select(F.col("id").alias(column), F.col("component").alias("_c")),
                      column, "left")
            .withColumn(name, F.coalesce("_c", column)).drop("_c"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    return (_labelled(_labelled(pairs, labels, "a", "ca"), labels, "b", "cb")
            .filter("ca <> cb").select("a", "b"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents; the smallest id of a group is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs, run_folder(spark, "minhash")).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"))
