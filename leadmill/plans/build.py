"""Building models into tables, in full or by delta."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from leadmill.functions import stamp
from leadmill.operators.tables import LOAD, Warehouse
from leadmill.operators.upsert import sync_columns
from leadmill.operators.watermarks import affected_keys, both_sides, high_water, restrict_inputs
from leadmill.plans.models import LAYERS, MODELS_BY_REF, ModelSpec, build_order

LAST_RUN = "leadmill.last_run"
# One property for each input: the last load that the model has read of it.
SEEN = "leadmill.seen."
# Inputs are cut to what the affected keys reach where these are at most one in so many of the driving rows.
CUT_BELOW = 4
# Where the affected keys are more than this share of the driving rows, all rows are recomputed and written.
REBUILD_ABOVE = 0.75


def table_of(ref: str) -> str:
    spec = MODELS_BY_REF.get(ref)
    return spec.table if spec else ref


def is_read(spec: ModelSpec) -> bool:
    """Whether any model reads this one. Versions that were replaced in other tables have no reader."""
    return any(MODELS_BY_REF.get(ref) and MODELS_BY_REF[ref].name == spec.name for m in MODELS_BY_REF.values() for ref in m.inputs.values())


def read_inputs(warehouse: Warehouse, spec: ModelSpec) -> dict[str, DataFrame]:
    return {arg: warehouse.read(table_of(ref)) for arg, ref in spec.inputs.items()}


def run_model(
    warehouse: Warehouse,
    spec: ModelSpec,
    as_of: datetime,
    delta: str = "affected_keys",
    on_duplicate_key: str = "error",
) -> None:
    """Bring one model's table up to date, and note the run with the table.

    The first run builds it in full. After that ``delta`` says how: ``affected_keys`` recomputes the
    rows that any changed input can reach (all rows, where these are most of them), from whole inputs, and ends where a
    full build would (a calendar that grows backwards needs ``full``); ``both_sides`` cuts every input to its new rows
    before joining; ``full`` recomputes and upserts.
    """
    # Read before the inputs are, so that what is committed meanwhile counts as unseen.
    seen = {name: warehouse.newest_load(table_of(ref)) for name, ref in spec.inputs.items()}
    before = seen_loads(warehouse, spec)
    _run_model(warehouse, spec, as_of, delta, on_duplicate_key)
    noted = {f"{SEEN}{name}": str(max(load, before.get(name, 0))) for name, load in seen.items()}
    warehouse.set_properties(spec.table, **{LAST_RUN: as_of.isoformat(), **noted})


def seen_loads(warehouse: Warehouse, spec: ModelSpec) -> dict[str, int]:
    """The last load of each input that a model has read, where one is noted."""
    notes = warehouse.properties(spec.table) if warehouse.exists(spec.table) else {}
    found = {name: notes.get(f"{SEEN}{name}", "") for name in spec.inputs}
    return {name: int(load) for name, load in found.items() if load.isdigit()}


def _run_model(warehouse: Warehouse, spec: ModelSpec, as_of: datetime, delta: str, on_duplicate_key: str) -> None:
    inputs = read_inputs(warehouse, spec)
    exact = delta == "affected_keys"
    if not warehouse.exists(spec.table):
        warehouse.replace(spec.table, spec.build(**inputs, as_of=as_of), bucket_key=spec.driver_key)
        return
    target = warehouse.read(spec.table)
    if spec.materialized == "table":
        rows = spec.build(**inputs, as_of=as_of)
        warehouse.replace(spec.table, rows, unchanged_by=spec.key if exact else None)
        return
    options = dict(on_duplicate_key=on_duplicate_key, on_schema_change=spec.on_schema_change)
    if spec.full_refresh or delta == "full":
        rows = spec.build(**inputs, as_of=as_of)
        warehouse.upsert(
            spec.table, rows, spec.key, only_changes=exact, track=as_of if exact and is_read(spec) else None, **options
        )
    elif delta == "both_sides":
        rows = spec.build(**both_sides(spec, inputs, target), as_of=as_of)
        warehouse.upsert(spec.table, rows, spec.key, **options)
    elif exact:
        _run_affected(warehouse, spec, inputs, target, as_of)
    else:
        raise ValueError(f"delta must be 'affected_keys', 'both_sides' or 'full', not {delta!r}")


def _run_affected(
    warehouse: Warehouse, spec: ModelSpec, inputs: dict[str, DataFrame], target: DataFrame, as_of: datetime
) -> None:
    last_run = warehouse.properties(spec.table).get(LAST_RUN)
    bound = stamp(datetime.fromisoformat(last_run)) if last_run else high_water(target)
    # What was read bounds the delta, not the clock: a load may be committed after runs later than its rows' stamps.
    seen = seen_loads(warehouse, spec)
    linked = [name for name in inputs if name == spec.driver or name in spec.links]
    changed = {name: warehouse.changed_since(table_of(spec.inputs[name]), LOAD, F.lit(seen.get(name, -1))) for name in linked}
    # What changed is found already, so only the other rows are looked up.
    settled = {name: warehouse.unchanged_since(table_of(spec.inputs[name]), seen.get(name, -1)) for name in linked}
    keys = affected_keys(spec, settled, changed)
    if spec.ages:
        # Rows that depend on today's date are due again once the date has moved on.
        last_day = F.to_date(bound)
        due = (last_day < F.to_date(stamp(as_of))) & spec.ages(last_day)
        keys = keys.unionByName(inputs[spec.driver].where(due).select(spec.driver_key)).distinct()
    scratch = f"{spec.table}__affected"
    warehouse.write(scratch, keys)
    keys = warehouse.read(scratch)
    affected = keys.count()
    total = inputs[spec.driver].count() if affected else 0
    track = as_of if is_read(spec) else None
    if affected > REBUILD_ABOVE * total:
        # Cutting the inputs, and finding the old rows that stay, would move all rows once more for each of both.
        rows = sync_columns(target, spec.build(**inputs, as_of=as_of), spec.on_schema_change)[1]
        warehouse.replace(spec.table, rows, track=track)
    elif affected:
        few = affected * CUT_BELOW <= total
        rows = spec.build(**restrict_inputs(spec, inputs, keys, few), as_of=as_of)
        warehouse.replace_keys(
            spec.table, rows, keys, spec.driver_key, on_schema_change=spec.on_schema_change, track=track
        )
    warehouse.drop(scratch)


def build(
    warehouse: Warehouse,
    layer: str,
    as_of: datetime,
    delta: str = "affected_keys",
    on_duplicate_key: str = "error",
) -> list[str]:
    """Build all models of a layer (staging, dimensions, facts), each after the ones it reads."""
    done = []
    for spec in build_order(layer):
        run_model(warehouse, spec, as_of, delta, on_duplicate_key)
        done.append(spec.table)
    return done


def forget_seen(warehouse: Warehouse) -> None:
    """Drop the tracked row versions that every model which reads them has taken in."""
    until: dict[str, int] = {}
    for spec in MODELS_BY_REF.values():
        seen = seen_loads(warehouse, spec)
        for name, ref in spec.inputs.items():
            table = table_of(ref)
            until[table] = min(seen.get(name, 0), until.get(table, seen.get(name, 0)))
    for table, load in until.items():
        if load:
            warehouse.forget(table, load)


def build_all(warehouse: Warehouse, as_of: datetime, **options) -> list[str]:
    done = [table for layer in LAYERS for table in build(warehouse, layer, as_of, **options)]
    forget_seen(warehouse)
    return done
