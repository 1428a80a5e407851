"""Full preparation run (I1-I3): audit -> types -> missing -> outliers ->
features -> select -> validate.

Each stage is ``fit`` (one or a few aggregates; only per-column scalars reach
the driver) followed by ``apply`` (one lazy projection with literals), so the
final DataFrame is a flat chain of projections over the source scan.  With
``checkpoint=True`` every stage output is cut from its lineage into the
cluster's checkpoint folder (useful when the source is expensive to re-read).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..functions.columns import nan_to_null
from ..operators import advise as AD
from ..operators import features as FE
from ..operators import gates as GA
from ..operators import impute as IM
from ..operators import outliers as OU
from ..operators import profile as PR
from ..operators import select as SE
from ..operators import types as TY
from ..operators import validate as VA
from ..session import cut_lineage
from ..sources.store import RunStore

STAGES = ["intake", "audit", "types", "missing", "outliers", "features", "select", "validate"]


class StageError(RuntimeError):
    """Fail-fast (I2): carries the failing stage and the steps completed."""

    def __init__(self, stage: str, completed: list, cause: Exception):
        super().__init__(f"{stage} failed: {cause}")
        self.failed_at = stage
        self.steps_completed = completed
        self.cause = cause


@dataclass
class Prepared:
    df: DataFrame
    run_id: str
    store: RunStore
    fits: dict = field(default_factory=dict)
    status: str = ""
    warnings: list = field(default_factory=list)
    errors: list = field(default_factory=list)
    stats: dict = field(default_factory=dict)
    steps_completed: list = field(default_factory=list)
    timings: dict = field(default_factory=dict)
    gates: list = field(default_factory=list)
    steps_resumed: list = field(default_factory=list)

    def report(self) -> DataFrame:
        return self.store.report()


def prepare(df: DataFrame, target: str | None = None, outlier_action: str = "clip",
            polynomial: bool = False, drop_threshold: float = IM.DROP_THRESHOLD,
            variance_threshold: float = SE.VARIANCE_THRESHOLD,
            correlation_threshold: float = SE.CORRELATION_THRESHOLD,
            protect_target: bool = True, overrides: dict | None = None,
            run_id: str | None = None, store: RunStore | None = None,
            checkpoint: bool = False, exact: bool = True, type_method: str = "auto",
            persist: bool = True, resume: bool = False, adviser: Callable[[dict], dict] | None = None,
            adviser_timeout: float | None = None) -> Prepared:
    """Run all stages.  ``persist`` keeps the input in executor memory/disk
    while the ~20 fit aggregates scan it (lost blocks are recomputed from
    lineage); it is released before returning.

    Every stage's fit is saved in the store as soon as the stage is done.
    ``resume`` takes the fits that run ``run_id`` has saved there, from this
    driver or another, and runs only the stages behind them; other parameters
    or another table than the run began with raise.

    ``adviser`` is asked for the strategy of every column with holes (see
    ``operators.advise``); ``overrides`` go before its advice.
    """
    spark = df.sparkSession
    df = nan_to_null(df)
    owned = persist and not df.is_cached        # never release a cache the caller made
    if owned:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    run_id = run_id or f"run_{uuid.uuid4().hex[:8]}"
    store = store or RunStore(spark)
    protect = (target,) if (target and protect_target) else ()
    res = Prepared(df, run_id, store)
    cur = df
    begun = {"columns": [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "target": target,
             "outlier_action": outlier_action, "polynomial": polynomial, "drop_threshold": drop_threshold,
             "variance_threshold": variance_threshold, "correlation_threshold": correlation_threshold,
             "protect_target": protect_target, "exact": exact, "type_method": type_method}
    saved = store.load_fits(run_id) if resume else {}
    if resume and not saved:
        raise ValueError(f"run {run_id!r} has saved no fits")
    if saved and saved["run"] != begun:
        other = [k for k in begun if saved["run"].get(k) != begun[k]]
        raise ValueError(f"run {run_id!r} began with another {', '.join(other)}")
    if not saved:
        store.save_fit(run_id, "run", begun)

    def barrier(d):
        return cut_lineage(d) if checkpoint else d

    def stage(name, fn):
        t0 = time.time()
        if name in saved:
            res.steps_completed.append(name)
            res.steps_resumed.append(name)
            return saved[name]
        try:
            with store.batch():                     # report, step and fit of a stage are one commit
                out = fn()
                if name != "validate":
                    store.save_fit(run_id, name, out)
        except StageError:
            raise
        except Exception as e:  # noqa: BLE001
            raise StageError(name, list(res.steps_completed), e) from e
        res.steps_completed.append(name)
        res.timings[name] = round(time.time() - t0, 3)
        return out

    # intake (A4) + audit (B): one profile aggregate and one duplicate count
    def _audit():
        a = PR.audit(cur)
        store.add_report(run_id, "intake", [(None, "rows", a.rows), (None, "columns", len(cur.columns))]
                         + [(c, "column_name", c) for c in cur.columns], label="intake")
        rows = [(None, "rows", a.rows), (None, "duplicate_rows", a.duplicate_rows),
                (None, "overall_quality", a.overall_quality)]
        rows += [(c, "null_count", n) for c, n in a.null_counts.items()]
        rows += [(c, "null_pct", p) for c, p in a.null_pct.items()]
        rows += [(c, "zero_variance", True) for c in a.zero_variance]
        rows += [(c, f"flag:{kind}", value) for kind, c, value in a.flags]
        store.add_report(run_id, "audit", rows, label="quality_report")
        return a
    a = res.fits["audit"] = stage("audit", _audit)
    res.steps_completed.insert(0, "intake")

    # types (C)
    def _types():
        t = TY.fit_types(cur, type_method)
        rows = [(c, "semantic", s) for c, s in t.semantic.items()]
        rows += [(c, "dtype", d) for c, d in t.dtypes.items()]
        rows += [(c, "cast", to) for c, to in TY.cast_log(t)]
        store.add_report(run_id, "types", rows, label="type_report")
        return t
    tfit = res.fits["types"] = stage("types", _types)
    cur = barrier(TY.apply_types(cur, tfit))

    # missing (D)
    def _missing():
        # datetime casts keep every non-null value (all of them parsed), so the
        # audit's null counts still hold: no new scan for null fractions
        fr = {c: (n / a.rows if a.rows else None) for c, n in a.null_counts.items()}
        advice, faults = dict(overrides or {}) if not isinstance(overrides, DataFrame) else overrides, []
        if adviser is not None:
            if isinstance(advice, DataFrame):
                raise ValueError("give overrides as a dict beside an adviser")
            told = AD.column_facts(cur, tfit.semantic, fr, drop_threshold, protect)
            for r in AD.advise_columns(told, adviser, timeout=adviser_timeout).collect():     # at most one row per column
                faults += [(r["column"], AD.ERROR, r[AD.ERROR])] if r[AD.ERROR] else []
                if r["strategy"] is not None:
                    advice.setdefault(r["column"], r["strategy"])
        m = IM.fit_impute(cur, tfit.semantic, drop_threshold, advice, protect, exact_median=exact,
                          fractions=fr)
        rows = [(c, "strategy", a.action) for c, a in m.actions.items()]
        rows += [(c, "log", a.log) for c, a in m.actions.items()]
        rows += [(c, "fill", a.fill) for c, a in m.actions.items() if a.fill is not None] + faults
        store.add_report(run_id, "missing", rows, label="missing_report")
        return m
    mfit = res.fits["missing"] = stage("missing", _missing)
    cur = barrier(IM.apply_impute(cur, mfit))

    # outliers (E)
    def _outliers():
        if outlier_action not in OU.ACTIONS:
            raise ValueError(f"unknown outlier action {outlier_action!r}; expected one of {OU.ACTIONS}")
        o = OU.fit_outliers(cur, protect=protect, exact=exact)
        rep, total, _ = OU.report_and_total(cur, o)
        rows = [(None, "action", outlier_action), (None, "total_outlier_rows", total)]
        for r in rep:
            rows += [(r["column"], k, r[k]) for k in ("outlier_count", "lower_bound", "upper_bound", "pct_outliers")]
        store.add_report(run_id, "outliers", rows, label="outlier_report")
        return o
    ofit = res.fits["outliers"] = stage("outliers", _outliers)
    cur = barrier(OU.apply_outliers(cur, ofit, outlier_action))
    if outlier_action == "drop" and "outliers" not in saved:
        store.add_report(run_id, "outliers", [(None, "rows_dropped", a.rows - cur.count())], label="outlier_rows")

    # features (F)
    def _features():
        cats = [c for c, k in tfit.semantic.items() if k == "categorical" and c in cur.columns]
        enc = FE.fit_encode(cur, cats)
        out, log = FE.engineer(cur, tfit.semantic, polynomial, encode_fit=enc)
        store.add_report(run_id, "features", [(",".join(f.sources), "engineered", f"{f.kind}:{f.count}") for f in log]
                         + [(None, "new_columns", len(out.columns))], label="feature_report")
        return enc
    enc = res.fits["encode"] = stage("features", _features)
    res.fits["polynomial"] = polynomial
    cur, derived = FE.engineer(cur, tfit.semantic, polynomial, encode_fit=enc)
    cur = barrier(cur)

    # select (G)
    def _select():
        # centres near each mean: IQR midpoints of the clipped columns, 0 for small derived codes/parts
        centers = {c: (f.q1 + f.q3) / 2 for c, f in ofit.fences.items() if f.q1 is not None}
        s = SE.fit_select(cur, target, variance_threshold, correlation_threshold, strict_target=False,
                          centers=centers)
        rows = [(c, "kept", True) for c in s.kept] + [(c, "removed", why) for c, why in s.removed]
        store.add_report(run_id, "select", rows, label="selector_report")
        return s
    sfit = res.fits["select"] = stage("select", _select)
    cur = SE.apply_select(cur, sfit)

    # validate (H)
    def _validate():
        done = store.steps(run_id)
        missing = [s for s in VA.EXPECTED_STEPS if s not in done]
        n_rows, nulls = VA.shape_and_nulls(cur)
        st = {"rows": n_rows, "columns": len(cur.columns)}
        status, errors, warnings = VA.status_of(st["rows"], st["columns"], nulls, missing)
        res.status, res.errors, res.warnings = status, errors, warnings
        res.stats = {
            "original_quality": res.fits["audit"].overall_quality,
            "features_engineered": len(derived),
            "features_removed": len(sfit.removed),
            "features_kept": len(sfit.kept),
            "outlier_rows_flagged": next((r["value"] for r in store.stage_report(run_id, "outliers").where(
                "metric = 'total_outlier_rows'").select("value").collect()), "N/A"),
        }
        rows = [(None, "pipeline_status", status), (None, "rows", st["rows"]), (None, "columns", st["columns"])]
        rows += [(c, "residual_nulls", n) for c, n in nulls.items()]
        rows += [(None, "missing_step", s) for s in missing]
        rows += [(c, f"warning:{k}", v) for k, c, v in warnings] + [(c, f"error:{k}", v) for k, c, v in errors]
        store.add_report(run_id, "validate", rows, label="validation_report")
        res.gates = run_gates(res, n_rows, nulls, target, len(df.columns), cur.columns)
        store.add_report(run_id, "gates", [(c, f"{g}:{'fired' if f else 'ok'}", o) for g, c, o, _, f in res.gates],
                         label="gate_report")
    stage("validate", _validate)
    if owned:
        df.unpersist()
    res.df = cur
    return res


def run_gates(res: Prepared, n_rows: int, residual: dict, target: str | None, n_cols_in: int,
              cols_out) -> list[tuple]:
    """Contract gates evaluated from the fitted per-column scalars of this run
    (no extra scan): ``(rule, column, observed, limit, fired)``."""
    L = GA.LIMITS
    a, t, m, o, s = (res.fits[k] for k in ("audit", "types", "missing", "outliers", "select"))
    out = []
    pcts = [p for p in a.null_pct.values() if p is not None]
    share = sum(p > L["J1_col"] for p in pcts) / len(pcts) if pcts else 0.0
    out.append(("J1", None, share, L["J1"], share > L["J1"]))
    out.append(("J2", None, a.rows - a.duplicate_rows, L["J2"], a.rows - a.duplicate_rows < L["J2"]))
    nums = [c for c, k in t.semantic.items() if k in ("numeric", "id") and c in a.null_counts]
    zero = sum(c in a.zero_variance for c in nums) / len(nums) if nums else 0.0
    out.append(("J3", None, zero, 1.0, bool(nums) and zero == 1.0))
    worst = max(pcts) if pcts else 0.0
    out.append(("J4", None, worst, L["J4"], worst > L["J4"]))
    unknown = sum(k == "unknown" for k in t.semantic.values()) / max(len(t.semantic), 1)
    out.append(("J6", None, unknown, L["J6"], unknown > L["J6"]))
    for c, act in m.actions.items():
        if act.action in ("mean", "median", "mode", "constant"):
            out.append(("J12", c, act.null_fraction, L["J12"], act.null_fraction > L["J12"]))
    iqr0 = [c for c, f in o.fences.items() if f.iqr == 0]
    out += [("J14", c, 0.0, 0.0, True) for c in iqr0]
    kept = len(s.kept)
    out.append(("J18", None, kept, L["J18_min"], kept < L["J18_min"]))
    loss = 1 - n_rows / a.rows if a.rows else 0.0
    out.append(("J19", None, loss, L["J19_loss"], loss > L["J19_loss"]))
    if target:
        out.append(("J19", target, 0.0 if target in cols_out else 1.0, 0.0, target not in cols_out))
    route = ("missing" if residual else "features" if len(cols_out) > L["J20_growth"] * max(n_cols_in, 1)
             else "outliers" if loss > L["J19_loss"] else None)
    out.append(("J20", route, loss, L["J19_loss"], route is not None))
    return out
