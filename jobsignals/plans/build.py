"""All layers from raw postings to marts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from jobsignals.operators.quality import WatchedWrites
from jobsignals.plans.enrichment import enriched_postings, mapped_postings
from jobsignals.plans.marts import (
    barrier_states,
    experience_barrier_of,
    occupation_dim,
    skill_states,
    skills_demand_of,
    supply_demand_of,
    supply_states,
)
from jobsignals.plans.staging import (
    staged_invitation_rounds,
    staged_occupation_lists,
    staged_postings,
)
from jobsignals.sources.tables import materialise, one_of, read_table, replace_partitions

BY_DAY = ["snapshot_date"]
MAPPED_ORDER = ["state", "sponsorship_signal", "remote_friendly"]


def build(
    raw: DataFrame,
    extracts: DataFrame,
    seeds: Mapping[str, DataFrame],
    storage: str | None = None,
    title_patterns: Sequence[Mapping] | None = None,
    days: Sequence[date] | None = None,
    layer_name: str | None = None,
    comments: Mapping[str, Mapping[str, str]] | None = None,
    watched: WatchedWrites | None = None,
) -> dict[str, DataFrame]:
    """Every layer by name, lazily, or written under ``storage``.

    ``title_patterns`` gives the patterns as rows, which map titles by one expression; without it the
    pattern table of ``seeds`` is joined. A written build stores the staged and the mapped postings,
    partitioned by day and sorted by the columns the facts filter on; the enriched postings are the
    mapped ones without the code. ``comments`` documents columns by layer and column, and a build
    without ``storage`` but with ``layer_name`` saves catalog tables in that schema.

    ``days`` limits the work on postings to those snapshots: only their partitions of the raw and
    extract tables are read, only their partitions of the stored postings are replaced, and a day
    that has no postings any more loses its partitions. No posting spans two snapshots, so the
    result equals a full build when the other days and the patterns are unchanged.

    The marts always cover all days, but a written build derives them from daily states (counts per
    day that add up), which lie beside the postings: of postings only those of ``days`` are read.
    ``watched`` counts the row checks of every layer that is written, of the rows that are written;
    checks on the enriched postings are counted with the mapped ones, which hold the same rows.
    """
    if days is not None and storage is None:
        raise ValueError("days needs a stored build to refresh")
    spark = raw.sparkSession

    def checked(df: DataFrame, name: str) -> DataFrame:
        for table in [name, *(["enriched_postings"] if name == "mapped_postings" else [])]:
            df = watched.watch(df, table) if watched else df
        return df

    def layer(df: DataFrame, name: str, partition_by=(), cluster_by=()) -> DataFrame:
        if storage is None and layer_name is None:
            return df
        documented = (comments or {}).get(name)
        return materialise(checked(df, name), name, layer=layer_name, path=storage, partition_by=partition_by, cluster_by=cluster_by, comments=documented)

    def postings(df: DataFrame, name: str, cluster_by: Sequence[str]) -> DataFrame:
        if days is None:
            return layer(df, name, BY_DAY, cluster_by)
        path = f"{storage.rstrip('/')}/{name}"
        replace_partitions(checked(df, name), path, BY_DAY, cluster_by, covered=days)
        return spark.read.schema(df.schema).parquet(path)

    def states(make: Callable[..., DataFrame], name: str) -> DataFrame:
        """Counts that a mart is made of: by day and written, or of all postings at once."""
        if storage is None:
            return make(mapped)
        path = f"{storage.rstrip('/')}/{name}"
        schema = make(mapped, BY_DAY).schema
        refresh = days is not None and read_table(spark, path, schema) is not None
        # A store from before there were states gets those of all its days.
        new = make(mapped.where(one_of("snapshot_date", days)), BY_DAY) if refresh else make(mapped, BY_DAY)
        if refresh:
            replace_partitions(new, path, BY_DAY, [], covered=days)
            return spark.read.schema(schema).parquet(path)
        return materialise(new, name, path=storage, partition_by=BY_DAY)

    if days is not None:
        wanted = one_of("snapshot_date", days)
        raw, extracts = raw.where(wanted), extracts.where(wanted)
    lists = staged_occupation_lists(seeds["occupation_lists"])
    staged = postings(staged_postings(raw), "staged_postings", ["source_city"])
    todays = staged if days is None else staged.where(wanted)
    patterns = seeds["anzsco_title_patterns"] if title_patterns is None else title_patterns
    mapped = postings(mapped_postings(enriched_postings(todays, extracts), patterns), "mapped_postings", MAPPED_ORDER)
    dim = layer(occupation_dim(lists, seeds["anzsco_title_patterns"]), "occupation_dim")
    return {
        "staged_postings": staged,
        "staged_occupation_lists": lists,
        "staged_invitation_rounds": staged_invitation_rounds(seeds["eoi_invitations"]),
        "enriched_postings": mapped.drop("anzsco_code"),
        "mapped_postings": mapped,
        "occupation_dim": dim,
        "supply_demand": layer(
            supply_demand_of(states(supply_states, "supply_states"), dim, seeds["occupation_ceilings"]),
            "supply_demand",
            cluster_by=["list_membership"],
        ),
        "experience_barrier": layer(
            experience_barrier_of(states(barrier_states, "barrier_states"), dim), "experience_barrier", cluster_by=["state"]
        ),
        "skills_demand": layer(skills_demand_of(states(skill_states, "skill_states")), "skills_demand", cluster_by=["state"]),
    }
