"""From a customer's site list to a plan, and reference checks on text and configuration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cellcast.functions.scalar import normalize_lon, split_list
from cellcast.operators.ranking import cumulative_counts


def distinct_locations(rows: DataFrame, position: str = "position") -> DataFrame:
    """One row per (name, lat, lon at 6 decimals) with an id in order of first appearance.

    Ids come from the ranked first positions, counted per value range rather than by one global
    window over all locations.
    """
    keyed = rows.select(
        F.trim("name").alias("name"), F.round("lat", 6).alias("lat"), F.round(normalize_lon("lon"), 6).alias("lon"), F.col(position).alias("_pos")
    )
    first = keyed.groupBy("name", "lat", "lon").agg(F.min("_pos").alias("_pos"))
    order = cumulative_counts(first, "_pos").select("_pos", F.col("n_upto").alias("_k"))
    number = F.col("_k").cast("string")
    label = F.concat(F.lit("LOC-"), F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number))
    return first.join(order, "_pos").select(label.alias("location_id"), "name", "lat", "lon")


def asset_layer_plan(
    assets: DataFrame, aliases: DataFrame, standard: DataFrame, override: Sequence[str] | None = None
) -> DataFrame:
    """(asset_id, catalog_entry, layer_id, layer_source, problem).

    Run override beats the row's own list, which beats the standard set. A type that no alias
    resolves is a problem row, as is a listed layer outside the registry (`unknown_layers`).
    """
    entry = aliases.select(F.lower(F.trim("alias")).alias("_alias"), F.col("entry").alias("_entry"))
    joined = assets.withColumn("_alias", F.lower(F.trim("asset_type"))).join(entry, "_alias", "left")
    own = split_list(F.coalesce(F.col("layers"), F.lit("")))
    has_own = F.size(own) > 0
    everyone = standard.select(F.array_sort(F.collect_set("layer_id"))).scalar()
    if override is not None:
        layers, source = F.array(*[F.lit(x) for x in override]), F.lit("cli-override")
        resolved = F.col("asset_type")
    else:
        layers = F.when(has_own, own).otherwise(everyone)
        source = F.when(has_own, "row-override").otherwise("standard-set")
        resolved = F.when(has_own, F.col("asset_type")).otherwise(F.col("_entry"))
    return joined.select(
        "asset_id",
        resolved.alias("catalog_entry"),
        F.explode(layers).alias("layer_id"),
        source.alias("layer_source"),
        F.when(resolved.isNull(), F.lit("unknown asset type")).alias("problem"),
    )


def unknown_layers(plan: DataFrame, registry: DataFrame) -> DataFrame:
    return plan.select("layer_id").distinct().join(registry.select("layer_id"), "layer_id", "left_anti")


def match_region_profiles(locations: DataFrame, profiles: DataFrame) -> DataFrame:
    """(location_id, profile_id) where the country matches and the state is listed or blank on either side.

    `profiles` has arrays countries and states. Profiles without countries apply everywhere.
    """
    clean = lambda c: F.lower(F.trim(c))
    blank = F.col("_st").isNull() | F.col("_st").isin("", "nan", "none", "n/a", "-")
    loc = locations.select("location_id", clean("country").alias("_c"), clean("state").alias("_st"))
    prof = profiles.select(
        "profile_id", F.transform("countries", clean).alias("_countries"), F.transform("states", clean).alias("_states")
    )
    listed = prof.withColumn("_c", F.explode("_countries"))
    hits = loc.join(listed, "_c").select("location_id", "profile_id", "_st", "_states")
    anywhere = prof.where(F.size("_countries") == 0).select(F.collect_list(F.struct("profile_id", "_states"))).scalar()
    general = loc.withColumn("_p", F.explode(anywhere)).select("location_id", "_p.profile_id", "_st", "_p._states")
    fits = (F.size("_states") == 0) | blank | F.array_contains(F.col("_states"), F.col("_st"))
    return hits.unionByName(general).where(fits).select("location_id", "profile_id").distinct()


def uncovered_locations(locations: DataFrame, matches: DataFrame) -> DataFrame:
    return locations.join(matches.select("location_id").distinct(), "location_id", "left_anti")


def _marked_pairs(text: Column) -> Column:
    """Letter pairs with end marks; a pair's second occurrence is another token, so that sets count like multisets."""
    marked = F.concat(F.lit("\u0002"), text, F.lit("\u0003"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(marked) - 1), lambda i: F.substring(marked, i, F.lit(2)))
    nth = lambda g, i: F.size(F.filter(F.slice(pairs, 1, i + 1), lambda h: h == g)).cast("string")
    return F.transform(pairs, lambda g, i: F.struct(F.concat(g, nth(g, i)).alias("g"), i.alias("pos")))


def _inner_grams(text: Column) -> Column:
    """All stretches of up to three letters."""
    n = F.length(text)
    at = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(at(1), at(2), at(3)))


def fuzzy_candidates(queries: DataFrame, entries: DataFrame, threshold: float) -> DataFrame:
    """Pairs (query, low) that may reach the threshold: no other pair does.

    Near texts: at most k = (1 - threshold) x the longer length edits, each of which breaks two letter pairs,
    so of each side's pairs in one global order, rarest first, the first 2k + 1 must share one, at most k
    places apart, and all of them share all but 2k. Entries are keyed by (pair, length), and a query asks for
    the lengths that can match.
    Contained texts: an entry that holds the query holds the query's rarest stretch of three letters.
    """
    e_pairs = entries.select("low", F.length("low").alias("n"), F.explode(_marked_pairs(F.col("low"))).alias("_p")).select("low", "n", "_p.g", "_p.pos")
    rarity = e_pairs.groupBy("g").agg(F.count("*").alias("often"))

    def in_order(df: DataFrame, name: str) -> DataFrame:
        ranked = df.join(rarity, "g", "left").groupBy(name, "n").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "g", "pos"))).alias("_all"))
        return ranked.select(name, "n", F.posexplode("_all").alias("rank", "_p")).select(name, "n", "rank", "_p.g", "_p.pos")

    q_pairs = queries.select("query", F.length("query").alias("n"), F.explode(_marked_pairs(F.col("query"))).alias("_p")).select("query", "n", "_p.g", "_p.pos")
    edits = lambda a, b: F.floor((1 - threshold) * F.greatest(a, b) + 1e-9)
    asked = in_order(q_pairs, "query").withColumnsRenamed({"n": "_qn", "rank": "_qr", "pos": "_qp"})
    span = F.sequence(F.ceil(F.col("_qn") * threshold - 1e-9).cast("int"), F.floor(F.col("_qn") / threshold + 1e-9).cast("int"))
    asked = asked.withColumn("n", F.explode(span)).where(F.col("_qr") < 2 * edits(F.col("_qn"), F.col("n")) + 1)
    k = edits(F.col("_qn"), F.col("n"))
    met = asked.join(in_order(e_pairs, "low"), ["g", "n"]).where((F.col("rank") < 2 * k + 1) & (F.abs(F.col("_qp") - F.col("pos")) <= k))
    met = met.select("query", "low").distinct()
    # and of all their pairs, all but two per edit
    tags = lambda c: F.transform(_marked_pairs(F.col(c)), lambda p: p["g"])
    n, m = F.length("query"), F.length("low")
    near = met.where(F.size(F.array_intersect(tags("query"), tags("low"))) >= F.greatest(n, m) + 1 - 2 * edits(n, m))
    if threshold > CONTAINED:
        return near
    e_grams = entries.select("low", F.explode(_inner_grams(F.col("low"))).alias("g"))
    seen = e_grams.groupBy("g").agg(F.count("*").alias("often"))
    whole = F.filter(_inner_grams(F.col("query")), lambda g: F.length(g) == F.least(F.length("query"), F.lit(3)))
    rarest = queries.select("query", F.explode(whole).alias("g")).join(seen, "g", "left").groupBy("query").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "g")).alias("_r"))
    held = rarest.select("query", F.col("_r.g").alias("g")).join(e_grams, "g").where(F.contains(F.col("low"), F.col("query"))).select("query", "low")
    return near.unionByName(held).distinct()


#: Least score of an entry that contains the query.
CONTAINED = 0.8


def fuzzy_match(names: DataFrame, dictionary: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Best dictionary entry per distinct name: exact 1.0, contained text at least 0.8, else 1 - edits/length."""
    if threshold < 0.5:
        raise ValueError("letter-pair candidates are complete only for thresholds from 0.5")
    q = names.select(F.lower(F.trim("name")).alias("query")).distinct().where(F.length("query") > 0)
    d = dictionary.select("entry", F.lower(F.trim("entry")).alias("low")).distinct()
    pairs = fuzzy_candidates(q, d.select("low").distinct().where(F.length("low") > 0), threshold)
    longest = F.greatest(F.length("query"), F.length("low"))
    similar = 1 - F.levenshtein("query", "low") / longest
    inside = F.contains(F.col("low"), F.col("query"))
    score = F.when(F.col("query") == F.col("low"), 1.0).when(inside, F.greatest(similar, F.lit(CONTAINED))).otherwise(similar)
    scored = pairs.withColumn("score", score).where(F.col("score") >= threshold).join(d, "low")
    best = scored.groupBy("query").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("entry").alias("e"))).alias("_b"))
    return q.join(best, "query", "left").select("query", F.col("_b.e").alias("entry"), (-F.col("_b.s")).alias("score"))


def align_priority_sources(sources: Sequence[DataFrame], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Per key the value of the first source that has one, and which source that was.

    One grouped minimum over the union: a single shuffle with map-side combine, not a join per source.
    """
    tagged = [s.select(*keys, value).withColumn("source", F.lit(i)) for i, s in enumerate(sources)]
    everything = tagged[0]
    for t in tagged[1:]:
        everything = everything.unionByName(t)
    present = everything.where(F.col(value).isNotNull())
    return present.groupBy(*keys).agg(F.min(F.struct("source", value)).alias("_b")).select(
        *keys, F.col(f"_b.{value}").alias(value), F.col("_b.source").alias("source")
    )


CITATION = r"\[(data|dossier):([^\]]+)\]"


def resolve_citations(texts: DataFrame, targets: DataFrame, known_files: Sequence[str]) -> DataFrame:
    """(doc_id, kind, ref, problem) for citations in `text` that do not resolve.

    `targets` lists (target, key): a file name, or 'dossier', and the keys it holds.
    """
    found = texts.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(CITATION), F.lit(0))).alias("_c"))
    refs = found.select(
        "doc_id",
        F.regexp_extract("_c", CITATION, 1).alias("kind"),
        F.trim(F.regexp_extract("_c", CITATION, 2)).alias("ref"),
    ).distinct()
    is_data = F.col("kind") == "data"
    has_key = F.contains(F.col("ref"), F.lit("#"))
    target = F.when(is_data, F.trim(F.substring_index("ref", "#", 1))).otherwise("dossier")
    key = F.when(is_data, F.trim(F.substring_index(F.substring_index("ref", "#", -1), ":", 1))).otherwise(F.col("ref"))
    keyed = refs.withColumns({"target": target, "key": key})
    hits = targets.select("target", "key").distinct().withColumn("_hit", F.lit(True))
    problem = (
        F.when(is_data & ~has_key, "no key")
        .when(is_data & ~F.col("target").isin(list(known_files)), "unknown file")
        .when(F.col("_hit").isNull(), "unresolved")
    )
    return keyed.join(hits, ["target", "key"], "left").withColumn("problem", problem).where("problem IS NOT NULL").select(
        "doc_id", "kind", "ref", "problem"
    )


def common_decades(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("decade").intersect(b.select("decade"))


def paired_layers(a: DataFrame, b: DataFrame, scenario_pairs: DataFrame, keys: Sequence[str] = ("value_type", "decade", "cell_id")) -> DataFrame:
    """Old and new values of the same (scenario pair, keys); decades only one side has drop out."""
    old = a.join(scenario_pairs, a["scenario"] == scenario_pairs["old_scenario"]).select(
        "old_scenario", "new_scenario", *keys, F.col("value").alias("old_value")
    )
    new = b.select(F.col("scenario").alias("new_scenario"), *keys, F.col("value").alias("new_value"))
    return old.join(new, ["new_scenario", *keys])


def pair_common_events(hist: DataFrame, fut: DataFrame, key: Sequence[str] = ("event_id",)) -> DataFrame:
    """Events present on both sides, sizes side by side."""
    h = hist.groupBy(*key).agg(F.max("size").alias("hist_size"))
    f = fut.groupBy(*key).agg(F.max("size").alias("fut_size"))
    return h.join(f, list(key))


def event_eligibility(hist: DataFrame, fut: DataFrame, key: Sequence[str] = ("event_id",)) -> DataFrame:
    """Numbers of events on both sides and on one side only, from a single grouped pass."""
    both = hist.select(*key, F.lit(1).alias("_s")).unionByName(fut.select(*key, F.lit(2).alias("_s")))
    sides = both.groupBy(*key).agg(F.bit_or("_s").alias("_s"))
    return sides.agg(
        F.count_if(F.col("_s") == 3).alias("paired"), F.count_if(F.col("_s") == 1).alias("only_hist"), F.count_if(F.col("_s") == 2).alias("only_fut")
    )


def first_outliers(pairs: DataFrame, n: int = 10, n_sigma: float = 3.0, row: str = "grow", col: str = "gcol") -> DataFrame:
    """The first n outlying cells in row-major order: a top-n report."""
    diff = pairs.where("old_value IS NOT NULL AND new_value IS NOT NULL").withColumn("diff", F.col("new_value") - F.col("old_value"))
    stats = diff.agg(F.avg("diff").alias("m"), F.stddev_pop("diff").alias("s"))
    far = F.abs(F.col("diff") - stats.select("m").scalar()) > n_sigma * stats.select("s").scalar()
    return diff.where(far).orderBy(row, col).select(row, col, "diff").limit(n)


def availability_matrix(files: DataFrame, scenarios: Sequence[str]) -> DataFrame:
    """File counts per model, gcm and scenario column, with size and subtotals per model and overall."""
    flags = [F.count_if(F.col("scenario") == s).alias(s) for s in scenarios]
    return files.rollup("model", "gcm").agg(*flags, F.count("*").alias("n_files"), (F.sum("n_bytes") / 1e6).alias("megabytes"))


def members_missing(files: DataFrame, keys: Sequence[str] = ("model", "gcm")) -> DataFrame:
    """(keys, scenario) combinations that other members have and this member lacks."""
    scenarios = files.select(F.array_sort(F.collect_set("scenario"))).scalar()
    have = files.groupBy(*keys).agg(F.collect_set("scenario").alias("_have"))
    return have.select(*keys, F.explode(F.array_except(scenarios, "_have")).alias("scenario"))


def key_differences(values: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys missing from or extra in `values`, duplicates counted."""
    have, want = values.select(*keys), expected.select(*keys)
    missing = want.exceptAll(have).withColumn("side", F.lit("missing"))
    return missing.unionByName(have.exceptAll(want).withColumn("side", F.lit("extra")))
