"""Line deduplication by MinHash over character shingles, with DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesmith.llm.common import Stash, text_of
from tablesmith.llm.components import components
from tablesmith.llm.sieve import MAYBE, Sieve, packed
from tablesmith.llm.words import SIMILARITY

#: Characters of a shingle.
SHINGLE = 8
#: A signature: the least hash of each of BANDS * ROWS parts that shingles fall into; a band is ROWS of them in a row.
BANDS, ROWS = 8, 3
PARTS = BANDS * ROWS
#: A hash's last PLACE bits are its place in its part. A long line keeps the hashes of the lowest places alone, about
#: KEPT of them; if they leave more than two thirds of the parts empty, all hashes are kept after all.
PLACE, KEPT = 40, 3 * PARTS
#: More than any text's lines.
LINES = 1 << 32
#: The largest doc_id, positive or negative, whose lines' places are long integers.
SMALL = (1 << 30) - 1
#: Stands for a null doc_id, which comes after all others.
NO_DOC = str(1 << 63)
#: Lines of one side of a block of pairs.
BLOCK = 128
#: Lines round a centre up to which all pairs of them are looked at; more lines meet by what they share.
CROWD = 64
#: Letters of one side of a block, which very long lines may exceed.
LETTERS = 1 << 20
#: Words of 64 bits of a line's sketch, and their columns; two sketches stay within the 100 fields that Spark compiles a stage of.
WORDS = 40
SKETCH = [f"w{k}" for k in range(WORDS)]
#: Rows that a class's keeper is joined by, as one class may hold most lines.
SALTS = 16


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of all lines that have a word; line_no counts all lines from 0."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).filter(F.expr(r"trim(LEADING ' \t\n\u000B\u000C\r' FROM line) <> ''"))


def _shingles(lines: DataFrame) -> DataFrame:
    """(h, n, i, s) of lines(line): hashes of all shingles of all lines, a row each; n is how many the line has.

    A shingle is hashed as UTF-16, of which it is a slice of the line's unless there is a character of four bytes; only
    then is the line coded once more, as UTF-32.
    """
    coded = lines.select("line", F.xxhash64("line").alias("h"), F.encode("line", "UTF-16LE").alias("narrow"))
    wide = F.expr("if(octet_length(narrow) = 2 * length(line), null, encode(line, 'UTF-32'))").alias("wide")
    n = F.expr(f"greatest(1, if(wide is null, octet_length(narrow) div 2, octet_length(wide) div 4) - {SHINGLE - 1})").alias("n")
    sized = coded.select("h", "narrow", wide).select("h", "narrow", "wide", n)
    rows = sized.select("h", "n", "wide", "narrow", F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("i"))
    slow = f"encode(decode(substring(wide, 4 * i + 1, {4 * SHINGLE}), 'UTF-32'), 'UTF-16LE')"
    return rows.select("h", "n", "i", F.expr(f"xxhash64(if(wide is null, substring(narrow, 2 * i + 1, {2 * SHINGLE}), {slow}))").alias("s"))


def signatures(lines: DataFrame, kept: int | None = KEPT) -> DataFrame:
    """(h, n, bands, poor) of lines(line): a line's hash, which stands for its text, its shingles, and the bands of its signature.

    Shingles are exploded into rows, so that hashing, filtering and the least hashes all run in compiled code; they are
    combined by line on the map side. A part that no shingle fell into is passed over for the next one that has some,
    round the last part's end, so that each row of a band is a MinHash. poor: the kept hashes filled too few parts.
    """
    top = 1 << PLACE
    # The partition's number, which is never negative, keeps the filter above the hashes: Spark would make them twice, for the filter and for the rows.
    hashed = _shingles(lines).select("h", "n", "i", "s", F.spark_partition_id().alias("task"))
    place, part = F.expr(f"s & {top - 1}L").alias("place"), F.expr(f"cast(pmod(shiftright(s, {PLACE}), {PARTS}) as int)")
    low = F.expr(f"(s & {top - 1}L) * n < {top * kept}L" if kept else "true")
    kept_rows = hashed.filter(low | (F.col("i") == 0) | (F.col("task") < 0)).select("h", "n", F.when(low, part).alias("part"), place)
    # With FILTER, a row touches the one least hash of its own part and skips the others.
    least = [F.expr(f"min(place) FILTER (WHERE part = {k})").alias(f"m{k}") for k in range(PARTS)]
    mins = kept_rows.groupBy("h").agg(F.max("n").alias("n"), *least)
    full = [F.expr(" + ".join(f"if(m{k} is null, 0, 1)" for k in range(upto)) or "0") for upto in range(0, PARTS + 1, ROWS)]
    value = [f"m{k} + {k * top}L" for k in range(PARTS)]
    ordered = mins.select("*", *[f.alias(f"at{b}") for b, f in enumerate(full)])
    # Where no part is empty, as in most lines, the bands are hashes of columns, without arrays.
    whole = F.array(*[F.expr(f"xxhash64({', '.join(value[b * ROWS:(b + 1) * ROWS])})") for b in range(BANDS)])
    ordered = ordered.withColumn("v", F.when(F.col(f"at{BANDS}") < PARTS, F.array_compact(F.array(*map(F.expr, value)))))
    some = F.array(*[F.expr("xxhash64(" + ", ".join(f"v[(at{b} + {r}) % size(v)]" for r in range(ROWS)) + ")") for b in range(BANDS)])
    poor = (F.col(f"at{BANDS}") < BANDS) & (F.col("n") > (kept or 0)) if kept else F.lit(False)
    made = F.when(F.col(f"at{BANDS}") == PARTS, whole).when(F.col(f"at{BANDS}") > 0, F.array_distinct(some)).otherwise(F.array().cast("array<bigint>"))
    return ordered.select("h", "n", made.alias("bands"), poor.alias("poor"))


def _own() -> Column:
    """A line's place, as one number."""
    return F.xxhash64("doc_id", "line_no").alias("own")


def _once(docs: DataFrame, first: DataFrame, stash: Stash) -> DataFrame:
    """(line) of docs: each different line at least once, of most copies the first(h, doc_id, line_no, n) alone.

    A line goes if its hash may be that of copied lines and its place is surely none of the first places of all lines,
    copied or not, of which that holds. Each line's first place is thus kept, whatever the filters let pass besides.
    """
    copied = Sieve(stash(first.filter("n > 1").select("h"), plain=True), "h")
    places = Sieve(stash(copied.keep(first, "h").select(_own()), plain=True), "own")
    rows = lines_of(docs).select("line", F.xxhash64("line").alias("h"), _own())
    maybe = copied.split(rows, "h").withColumnRenamed(MAYBE, "copied")
    return places.split(maybe, "own").filter(f"not copied or {MAYBE}").select("line")


def _signed(docs: DataFrame, placed: DataFrame, first: DataFrame, stash: Stash) -> DataFrame:
    """(h, n, bands) of all different lines of docs."""
    signed = stash(signatures(_once(docs, first, stash)), plain=True)
    poor = stash(signed.filter("poor").select("h"), plain=True)
    if poor.isEmpty():
        return signed.select("h", "n", "bands")
    sieve = Sieve(poor, "h")
    held = stash(sieve.keep(placed, "h").select(F.xxhash64("doc_id").alias("key")).distinct())
    some = Sieve(held, "key").keep(docs.select("doc_id", "text", F.xxhash64(F.col("doc_id").cast("long")).alias("key")), "key")
    again = sieve.keep(lines_of(some).select("line", F.xxhash64("line").alias("h")), "h")
    full = stash(signatures(again, None).join(poor, "h", "left_semi"), plain=True)
    return signed.filter("not poor").select("h", "n", "bands").unionByName(full.select("h", "n", "bands"))


def _set(line: str) -> str:
    """Hashes of all of a line's shingles; four bytes a character make each of them a slice."""
    every = f"transform(sequence(1, greatest(1, octet_length(b) - {4 * SHINGLE - 1}), 4), i -> xxhash64(substring(b, i, {4 * SHINGLE})))"
    return f"array_distinct(transform(array(encode({line}, 'UTF-32')), b -> {every})[0])"


def _similar(a: str, b: str, threshold: float) -> str:
    """Whether two sets reach the similarity; their sizes alone may rule it out."""
    sizes = f"least(size({a}), size({b})) >= {float(threshold)}D * greatest(size({a}), size({b})) - 1e-9D"
    return f"({sizes} and size(array_intersect({a}, {b})) >= {threshold / (1 + threshold)}D * (size({a}) + size({b})) - 1e-9D)"


def _sketches(texts: DataFrame) -> DataFrame:
    """(h, n, w0, w1, ...) of texts(h, line): n is a line's shingles, and its WORDS words have a bit set for each of their hashes."""
    at = _shingles(texts.select("line")).select("h", "n", F.expr(f"cast(pmod(s, {WORDS}) as int)").alias("word"), F.expr("shiftleft(1L, cast(shiftright(s, 32) & 63L as int))").alias("bit"))
    words = [F.expr(f"bit_or(bit) FILTER (WHERE word = {k})").alias(w) for k, w in enumerate(SKETCH)]
    return at.groupBy("h").agg(F.max("n").alias("n"), *words).select("h", "n", *[F.coalesce(w, F.lit(0).cast("long")).alias(w) for w in SKETCH])


def _perhaps(a: str, b: str, threshold: float) -> str:
    """False if the sketches of two rows show that they can't reach the similarity.

    Each bit that is set in one sketch alone stands for a shingle that the other line lacks, and two similar sets differ
    by (1 - t) / (1 + t) of the sum of their sizes at most. Columns, not an array, keep the compiled method short enough
    for the JVM to compile it in its turn.
    """
    differ = " + ".join(f"bit_count({a}.{w} ^ {b}.{w})" for w in SKETCH)
    return f"{differ} <= {(1 - threshold) / (1 + threshold)}D * ({a}.n + {b}.n) + 1e-9D"


def _blocks(some: Column) -> Column:
    """How many blocks of BLOCK lines, and of LETTERS letters, hold some of a group's lines."""
    return F.ceil(F.greatest(F.count(F.when(some, 1)) / BLOCK, F.sum(F.when(some, F.col("n"))) / LETTERS)).cast("int")


def _labels(threshold: float) -> Column:
    """Components of a block's `lines`, array<struct<h, comp, shingles>>: for each line the place of another one of its component.

    Lines of one comp are connected from the start. The pairs of `links`, array<struct<i, j>> of places, are compared in
    turn, but for those that are connected by then.
    """
    near = _similar("lines[l.i].shingles", "lines[l.j].shingles", threshold)
    renamed = "transform(label, x -> if(x = label[l.j], label[l.i], x))"
    first = "transform(lines.comp, c -> cast(array_position(lines.comp, c) as int) - 1)"
    return F.expr(f"aggregate(links, {first}, (label, l) -> if(label[l.i] = label[l.j] or not {near}, label, {renamed}))")


def _members(signed: DataFrame, stash: Stash) -> DataFrame:
    """(band, h, n, centre): the lines of all bands that different lines share; the centre is a band's least line."""
    bands = signed.select("h", "n", F.explode("bands").alias("band"))
    crowded = stash(bands.groupBy("band").agg(F.min("h").alias("centre"), F.max("h").alias("last")).filter("centre <> last").select("band", "centre"), plain=True)
    return stash(Sieve(crowded, "band").keep(bands, "band").join(crowded, "band").select("band", "h", "n", "centre"), plain=True)


def _star_edges(members: DataFrame, texts: DataFrame, sketches: DataFrame, stash: Stash, threshold: float) -> DataFrame:
    """(src, dst): lines as similar as the threshold to the centre of a band of theirs."""
    pairs = members.filter("h <> centre").select("centre", "h").distinct()
    sides = [sketches.select(F.col("h").alias(name), F.struct("n", *SKETCH).alias(side)) for name, side in (("h", "x"), ("centre", "y"))]
    near = pairs.hint("merge").join(sides[0], "h").hint("merge").join(sides[1], "centre").filter(_perhaps("x", "y", threshold))
    pairs = stash(near.select("centre", "h", F.col("x.n").alias("n")), plain=True)
    sizes = pairs.groupBy("centre").agg(_blocks(F.lit(True)).alias("m"))
    dealt = pairs.join(sizes, "centre").select("centre", "h", F.expr("pmod(xxhash64(h, 'chunk'), m)").alias("chunk"))
    blocks = dealt.hint("merge").join(Sieve(pairs, "h").keep(texts, "h"), "h").groupBy("centre", "chunk").agg(F.collect_list(F.struct("h", "line")).alias("lines"))
    both = blocks.hint("merge").join(texts.select(F.col("h").alias("centre"), F.col("line").alias("middle")), "centre")
    sets = both.select("centre", F.expr(_set("middle")).alias("mid"), F.expr(f"transform(lines, x -> struct(x.h as h, {_set('x.line')} as shingles))").alias("lines"))
    # Rows and not a lambda, so that intersections are compiled; outer, as Spark would filter by the sets, made once more, for an inner explode.
    each = sets.select("centre", "mid", F.explode_outer("lines").alias("x"))
    found = each.filter(_similar("mid", "x.shingles", threshold)).select("centre", F.col("x.h").alias("dst"))
    return found.select(F.col("centre").alias("src"), "dst")


def _likely(dealt: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """(band, i, j, a, b): pairs of rows of dealt(band, i, j, h, comp, bands) of a block, each a struct of h and comp, that
    are of different comps and, by their sketches, may be similar. A pair is named in the first band alone that both are in.
    """
    sketched = dealt.hint("merge").join(sketches, "h")
    sides = [F.collect_list(F.when(F.expr(which), F.struct("h", "comp", "bands", "n", *SKETCH))).alias(name) for name, which in (("xs", "chunk = i"), ("ys", "chunk = j and i <> j"))]
    blocks = sketched.groupBy("band", "i", "j").agg(*sides).withColumn("ys", F.expr("if(i = j, xs, ys)"))
    # Pairs of one chunk are compared in the block of that chunk alone, all others from one side to the other.
    pairs = blocks.select("band", "i", "j", "ys", F.explode("xs").alias("x")).select("band", "i", "j", "x", F.explode("ys").alias("y"))
    pairs = pairs.filter("x.comp <> y.comp and (i <> j or x.h < y.h)").filter(_perhaps("x", "y", threshold))
    here = pairs.filter("array_min(array_intersect(x.bands, y.bands)) = band")
    return here.select("band", "i", "j", F.struct("x.h", "x.comp").alias("a"), F.struct("y.h", "y.comp").alias("b"))


def _differences(crowd: DataFrame, texts: DataFrame, stash: Stash) -> DataFrame:
    """crowd(centre, c, h, ...) with n, the line's different shingles, and d, those that it or the majority lacks.

    The majority of a centre's c lines has the shingles that more than half of them have.
    """
    sets = stash(crowd.hint("merge").join(Sieve(crowd, "h").keep(texts, "h"), "h").select(*crowd.columns, F.expr(_set("line")).alias("x")), plain=True)
    counts = sets.select("centre", "c", F.explode_outer("x").alias("e")).groupBy("centre", "e").agg(F.count("*").alias("df"), F.max("c").alias("c"))
    major = stash(counts.filter("2 * df > c").groupBy("centre").agg(F.collect_list("e").alias("major")))
    both = sets.join(major, "centre", "left").withColumn("major", F.coalesce("major", F.array().cast("array<bigint>")))
    return stash(both.select(*crowd.columns, F.size("x").alias("n"), F.expr("concat(array_except(x, major), array_except(major, x))").alias("d")), plain=True)


def _crowd_links(crowd: DataFrame, texts: DataFrame, sketches: DataFrame, stash: Stash, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Of crowd(centre, c, chunk, h, comp): links as _likely has them, and edges (src, dst) of comps that are surely linked.

    Near copies differ from their majority M in few shingles, most of them their own. With d(x) the shingles that x or M
    lacks, x and y differ in |d(x)| + |d(y)| - 2 |d(x) & d(y)| shingles, and are similar if that is at most share * (n(x) + n(y)).
    So with s = |d| - share * n they are similar if s(x) + s(y) <= 2 |d(x) & d(y)|. The line of the least s is thus similar
    to all whose s is at most its negative. All other pairs need common shingles in their differences, that many that two
    lines have one among the rarest |d| - a + 1 of each, where a is the least overlap that any partner asks for, and the
    first such one so early that enough can follow. No pair is lost, whatever the majority is.
    """
    share = (1 - threshold) / (1 + threshold)
    slack = f"dl - {share}D * n"
    lines = _differences(crowd, texts, stash).withColumn("dl", F.size("d")).withColumn("s", F.expr(slack))
    low = lines.groupBy("centre").agg(F.min("s").alias("least"), F.min_by("comp", "s").alias("best"))
    tied = stash(lines.join(low, "centre").filter("comp = best or s + least <= 1e-9D").select("centre", "comp", "best").distinct())
    sided = lines.join(tied.select("centre", "comp", F.lit(True).alias("same")), ["centre", "comp"], "left").withColumn("same", F.coalesce("same", F.lit(False)))
    bounds = sided.groupBy("centre").agg(F.min("s").alias("least"), F.min(F.when(~F.col("same"), F.col("s"))).alias("other")).filter("other is not null")
    asked = F.expr("cast(ceil(greatest(1D, (s + if(same, other, least)) / 2 - 1e-9D)) as int)")
    bound = sided.join(bounds, "centre").withColumn("upto", F.col("dl") - asked + 1).filter("upto > 0")
    own = ["centre", "chunk", "h", "comp", "same", "n", "dl"]
    # Dealt by line, as a centre's lines would be one task's after joins by centre.
    rows = bound.select(*own, "upto", "d").repartition("h").select(*own, "upto", F.explode_outer("d").alias("e"))
    rare = rows.withColumn("df", F.count("*").over(Window.partitionBy("centre", "e"))).filter("df > 1")
    line = Window.partitionBy("centre", "h")
    # Shingles that no other difference has come first, and are left out.
    placed = rare.withColumn("r", F.row_number().over(line.orderBy("df", "e")) + F.col("dl") - F.count("*").over(line))
    heads = stash(placed.filter("r <= upto").select(*own, "e", "r"), plain=True)
    sides = [heads.select("centre", "e", F.struct("chunk", "h", "comp", "same", "n", "dl", "r", F.expr(slack).alias("s")).alias(name)) for name in ("x", "y")]
    apart = f"x.comp <> y.comp and (y.same or x.h < y.h) and least(x.n, y.n) >= {float(threshold)}D * greatest(x.n, y.n) - 1e-9D"
    enough = "2 * (1 + least(x.dl - x.r, y.dl - y.r)) >= x.s + y.s - 1e-9D"
    met = sides[0].filter("not x.same").hint("merge").join(sides[1], ["centre", "e"]).filter(f"{apart} and {enough}")
    ends = [F.struct(f"{name}.h", f"{name}.comp").alias(to) for name, to in (("x", "a"), ("y", "b"))]
    pairs = met.select("centre", F.least("x.chunk", "y.chunk").alias("i"), F.greatest("x.chunk", "y.chunk").alias("j"), *ends).distinct()
    pairs = stash(pairs.withColumn("at", F.col("a.h")).withColumn("to", F.col("b.h")))
    sketched = [Sieve(pairs, name).keep(sketches.select(F.col("h").alias(name), F.struct("n", *SKETCH).alias(side)), name) for name, side in (("at", "x"), ("to", "y"))]
    both = pairs.hint("merge").join(sketched[0], "at").hint("merge").join(sketched[1], "to")
    links = both.filter(_perhaps("x", "y", threshold)).select(F.col("centre").alias("band"), "i", "j", "a", "b")
    return links, tied.filter("comp <> best").select(F.col("comp").alias("src"), F.col("best").alias("dst"))


def _rest_edges(members: DataFrame, labels: DataFrame, texts: DataFrame, sketches: DataFrame, stash: Stash, threshold: float) -> DataFrame | None:
    """(src, dst): comps that lines of a band link, which its star has left apart; none if there is no such band.

    Round a centre that at most CROWD lines are left of, all pairs of lines of different comps in a band are compared, in
    blocks of BLOCK lines a side, but for the centre, which all have been compared with: first by their sketches, then,
    where these leave it open, by all their shingles. The lines of one comp, the `same` ones, meet the others alone, not
    each other. Of more lines only those pairs are compared so whose common differences allow them to be similar.
    """
    comp = F.coalesce("label", "h")
    known = stash(members.filter("h <> centre").join(labels.toDF("h", "label"), "h", "left").select("band", "centre", "h", "n", comp.alias("comp")), plain=True)
    # Bands of the same lines need one look: they have the same number of lines and the same checksums.
    sums = [F.expr(f"bit_xor(xxhash64(h, {k}))").alias(f"sum{k}") for k in (1, 2)]
    ends = F.min("comp").alias("low"), F.max("comp").alias("high"), F.min_by("comp", "h").alias("top")
    apart = known.groupBy("band").agg(F.count("*").alias("n"), *sums, *ends).filter("low <> high")
    apart = stash(apart.groupBy("n", "sum1", "sum2").agg(F.min("band").alias("band"), F.first("top").alias("top")).select("band", "top"))
    if apart.isEmpty():
        return None
    every = stash(Sieve(apart, "band").keep(known, "band").join(apart, "band").select("band", "centre", "h", "n", "comp", (F.col("comp") == F.col("top")).alias("same")))
    groups = every.select("centre", "h", "n", "comp").distinct()
    crowds = stash(groups.groupBy("centre").agg(F.count("*").alias("c"), _blocks(F.lit(True)).alias("m")).filter(f"c > {CROWD}"))
    crowd = groups.join(crowds, "centre").select("centre", "c", F.expr("cast(pmod(xxhash64(h, 'chunk'), m) as int)").alias("chunk"), "h", "comp")
    met, sure = _crowd_links(stash(crowd, plain=True), texts, sketches, stash, threshold)
    left = every.join(crowds, "centre", "left_anti").drop("centre")
    sided = left.join(left.groupBy("h").agg(F.collect_list("band").alias("bands")), "h")
    chunks = [_blocks(F.col("same") == same).alias(name) for name, same in (("others", False), ("sames", True))]
    sized = sided.join(left.groupBy("band").agg(*chunks), "band")
    chunk = F.expr("if(same, others + pmod(xxhash64(h, 'chunk'), sames), pmod(xxhash64(h, 'chunk'), others))").cast("int")
    dealt = sized.withColumn("chunk", chunk).withColumn("other", F.expr("explode(sequence(0, if(same, others, others + sames) - 1))"))
    dealt = dealt.select("band", "h", "comp", "bands", "chunk", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))
    # A table of their own, as the JVM compiles no method as long as that of the pairs with what follows.
    links = stash(_likely(dealt, sketches, threshold).unionByName(met))
    ends = stash(links.select("band", "i", "j", F.explode(F.array("a", "b")).alias("e")).select("band", "i", "j", "e.h", "e.comp").distinct(), plain=True)
    blocks = ends.hint("merge").join(Sieve(ends, "h").keep(texts, "h"), "h").groupBy("band", "i", "j").agg(F.collect_list(F.struct("h", "comp", "line")).alias("lines"))
    linked = blocks.join(links.groupBy("band", "i", "j").agg(F.collect_list(F.struct("a.h", F.col("b.h").alias("to"))).alias("links")), ["band", "i", "j"])
    # Texts are dealt, as hashes of all their shingles are eight times as long.
    sets = F.expr(f"transform(lines, x -> struct(x.h as h, x.comp as comp, {_set('x.line')} as shingles))")
    places = F.expr("transform(links, l -> struct(cast(array_position(lines.h, l.h) as int) - 1 as i, cast(array_position(lines.h, l.to) as int) - 1 as j))")
    labelled = linked.select("band", sets.alias("lines"), places.alias("links")).withColumn("label", _labels(threshold))
    member = labelled.select(F.explode(F.expr("transform(sequence(0, size(lines) - 1), i -> struct(lines[i].comp as src, lines[label[i]].comp as dst))")).alias("e"))
    return member.select("e.src", "e.dst").filter("src <> dst").unionByName(sure).distinct()


def fuzzy_classes(docs: DataFrame, placed: DataFrame, first: DataFrame, stash: Stash, threshold: float) -> DataFrame:
    """(h, class) of the lines that are in one component with a different one as similar as the threshold."""
    members = _members(_signed(docs, placed, first, stash), stash)
    stash.keep_only(placed, first, members)
    named = stash(members.select("h").distinct(), plain=True)
    wanted = stash(Sieve(named, "h").keep(first, "h").join(named, "h").select("h", "doc_id", "line_no", _own()), plain=True)
    rows = lines_of(docs).select("doc_id", "line_no", "line", _own())
    found = Sieve(wanted, "own").keep(rows, "own").select(F.xxhash64("line").alias("h"), "line", "doc_id", "line_no")
    same = F.col("doc_id").eqNullSafe(F.col("at_doc")) & (F.col("line_no") == F.col("at_line"))
    held = found.join(wanted.select("h", F.col("doc_id").alias("at_doc"), F.col("line_no").alias("at_line")), "h").filter(same)
    texts = stash(held.select("h", "line").dropDuplicates(["h"]))
    sketches = stash(_sketches(texts), plain=True)
    stars = stash(_star_edges(members, texts, sketches, stash, threshold))
    labels = components(stars, stash)
    rest = _rest_edges(members, labels, texts, sketches, stash, threshold)
    if rest is None:
        return labels.toDF("h", "class")
    merged = components(stash(rest), stash).toDF("label", "class")
    alone = merged.join(labels.select("label"), "label", "left_anti").select(F.col("label").alias("h"), "class")
    known = labels.toDF("h", "label").join(merged, "label", "left").select("h", F.coalesce("class", "label").alias("class"))
    return known.unionByName(alone)


def _unplaced(place: str) -> tuple[Column, Column]:
    """The doc_id and line_no of a line's place."""
    doc = F.floor(F.col(place) / LINES)
    doc_id = F.when(doc < F.lit(NO_DOC).cast("decimal(20,0)"), doc).cast("long").alias("doc_id")
    return doc_id, F.pmod(place, F.lit(LINES).cast("decimal(11,0)")).cast("int").alias("line_no")


def line_classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row for each line of docs(doc_id, text, ...) that has a word: (doc_id, line_no, keep_doc_id, keep_line_no, kept).

    Equal lines, and lines whose sets of 8-character shingles have a Jaccard similarity of the threshold or more, are
    linked; of each connected component the line of the least (doc_id, line_no) is kept, which keep_doc_id and
    keep_line_no name. Lines of fewer than 8 characters are one shingle.

    Signatures are MinHash bands over all shingles of a line: 8 bands of 3 values. A pair at the threshold shares a band
    with a chance of 0.51, so of 8 bands it misses all in 0.3 % of cases. Lines are first compared with the least line
    of each of their bands, on all their shingles, and connected by union-find; then, in bands that are still apart, all
    pairs of lines that are not connected. Sketches of all shingles first rule out, exactly, most pairs that are not similar.
    Both run in blocks of 128 lines and some
    million letters a side, so that no task holds a band. Where more than 64 lines are left round a centre, only those
    pairs meet whose common differences from the majority allow them to be similar, which rules out no similar pair. Equal
    lines are one line throughout, aggregated before any shuffle, however often they occur. Lines are told apart by a
    64-bit hash of their text.

    Null is the empty text, which has no lines. Blank lines are no lines. Very long lines are shingled whole. A row
    that is repeated with its doc_id gives the same lines twice, all of them kept or none. Extra columns are ignored; an
    empty table gives no rows. A null doc_id comes after all others.
    """
    stash = Stash(docs.sparkSession, "lines")
    placed = stash(lines_of(docs).select("doc_id", "line_no", F.xxhash64("line").alias("h")), plain=True)
    # A line's place as one number, which Spark's hash aggregate can hold, while the least of structs would be sorted for:
    # a long integer where the doc_id is small enough, else a decimal.
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(NO_DOC).cast("decimal(20,0)"))
    place = doc * F.lit(LINES).cast("decimal(11,0)") + F.col("line_no")
    small = F.expr(f"coalesce(doc_id between {-SMALL} and {SMALL}, false)")
    least = placed.withColumn("small", small).groupBy("h").agg(
        F.min(F.when(~F.col("small"), place)).alias("far"),
        F.min(F.when(F.col("small"), F.col("doc_id") * LINES + F.col("line_no"))).alias("near"),
        F.count("*").alias("n"),
    )
    least = least.withColumn("place", F.least("far", F.col("near").cast("decimal(33,0)")))
    nearby = F.expr("cast(shiftright(near, 32) as bigint)"), F.expr(f"cast(near & {LINES - 1}L as int)")
    ends = [F.when(F.col("far").isNull(), own).otherwise(other).alias(name) for name, own, other in zip(("doc_id", "line_no"), nearby, _unplaced("place"))]
    first = stash(least.select("h", "place", "n", *ends), plain=True)
    fuzzy = stash(fuzzy_classes(docs, placed, first, stash, threshold), plain=True)
    stash.keep_only(placed, first, fuzzy)
    classed = stash(Sieve(fuzzy, "h").keep(first, "h").join(fuzzy, "h").select("h", "class", "place"))
    keeper = classed.groupBy("class").agg(F.min("place").alias("keeper")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = classed.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
    alone = first.filter("n > 1").join(fuzzy.select("h"), "h", "left_anti").select("h", F.col("place").alias("keeper"))
    shared = alone.unionByName(salted.join(keeper, ["class", "salt"]).select("h", "keeper"))
    shared = stash(shared.select("h", F.struct(*_unplaced("keeper")).alias("keeper")))
    stash.keep_only(placed, shared)
    both = Sieve(shared, "h").split(placed, "h")
    own = F.struct("doc_id", "line_no")
    met = both.filter(MAYBE).join(shared, "h", "left").select("doc_id", "line_no", F.coalesce("keeper", own).alias("keeper"))
    out = both.filter(f"not {MAYBE}").select("doc_id", "line_no", own.alias("keeper")).unionByName(met)
    return out.select("doc_id", "line_no", F.col("keeper.doc_id").alias("keep_doc_id"), F.col("keeper.line_no").alias("keep_line_no"), F.col("keeper").eqNullSafe(own).alias("kept"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """docs with the text's lines that are not kept removed; columns stay, and n_chars, if any, is counted anew.

    Blank lines stay. A document that loses lines and has no word left goes; all others stay, with null texts as they
    were. Documents that lose no line are not shuffled.
    """
    gone = line_classes(docs, **options).filter("not kept").groupBy(F.col("doc_id").alias("key")).agg(F.collect_set("line_no").alias("gone"))
    gone = Stash(docs.sparkSession, "gone")(gone)
    both = Sieve(gone, "key").split(packed(docs, "doc_id"), "key")
    clear = both.filter(f"not {MAYBE}").select("row.*")
    cut = both.filter(MAYBE).join(gone, "key", "left")
    whole = F.col("gone").isNull()
    cut = cut.withColumn("lines", F.split("row.text", "\n"))
    kept = F.array_join(F.expr("transform(array_except(sequence(0, size(lines) - 1), gone), i -> lines[i])"), "\n")
    cut = cut.withColumn("kept", F.when(whole, F.col("row.text")).otherwise(kept))
    cut = cut.filter(whole | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    new = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        new = new.withField("n_chars", F.when(whole, F.col("row.n_chars")).otherwise(F.length("kept")).cast(docs.schema["n_chars"].dataType))
    return clear.unionAll(cut.select(new.alias("row")).select("row.*"))
