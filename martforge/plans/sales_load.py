"""Sales normalisation (M15): text sales records -> products, customers,
reps, cust_reps, salestxn.

The source parses every sales file four times and resolves each row's keys
with three single-row SQL look-ups.  Here the records are read once (XML
sources), cached by the caller if reused, and every step is a set operation:

* products: distinct names numbered 1..n by first appearance (D1 + D5);
* customers: first row per name (its country wins, Q11), numbered 101..;
* reps: the rep records with ``r123`` ids parsed to ints (P2);
* key resolution: three joins on the natural keys (J3) with an orphan
  policy (default ``error``: an unmatched name aborts the load, as it does
  in the source);
* cust_reps: distinct (cid, rid) pairs (D3);
* salestxn: ``tid`` 1..n in record order, distributed (D6); the numbered
  records are staged once as a table, and within one load the dimensions are
  taken from it (first appearance = smallest tid).  A dimension asked for by
  itself only aggregates the records: nothing is numbered or written but its
  own distinct keys.  Products and customers are written before records look
them up.

"Record order" is given by ``order_cols`` (file and position for real files,
the source table's columns for the test views).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import clean as C
from martforge.operators import keys as K
from martforge.session import stored

TXN_FIELDS = ["date", "cust", "prod", "qty", "amount", "country", "repID"]
REP_FIELDS = ["rID", "firstName", "lastName", "territory"]


def stage_records(txn: DataFrame, order_cols: Sequence[str], order_source: DataFrame | None = None) -> DataFrame:
    """Number the records 1..n in record order (``tid``, D6).

    Records read from files with their position (``_file``, ``_pos``) are
    numbered from per-file counts, with no sort; any other order uses
    ``dense_ids_in_place`` if ``order_source`` names the table with the order
    columns that they were joined from, else ``dense_ids_by_range``.  Either way
    the numbered records are written once as a table in the checkpoint folder
    and every later step reads them (first appearance = smallest tid).
    """
    order = list(order_cols)
    if order == ["_file", "_pos"]:
        numbered = K.ids_from_positions(txn, "_file", "_pos", "tid").drop("_file", "_pos")
        return write_staged(numbered)
    number = K.dense_ids_by_range if order_source is None else K.dense_ids_in_place
    return number(txn, order, "tid", bounds_from=order_source, keep_order_cols=False)


def write_staged(df: DataFrame) -> DataFrame:
    from martforge.session import scratch_dir
    path = scratch_dir(df.sparkSession, "staged-records")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def load_reps(rep_records: DataFrame) -> DataFrame:
    """reps(rid, fname, lname, region) from rep records (rID like ``r12``)."""
    return rep_records.select(C.rep_id_parse("rID").alias("rid"),
                              F.col("firstName").alias("fname"),
                              F.col("lastName").alias("lname"),
                              F.col("territory").alias("region"))


def load_products(records: DataFrame, order: str | Sequence[str] = "tid") -> DataFrame:
    """products(pid, pname): distinct product names, pid 1..n by first use."""
    return (K.dense_key(records, "prod", order, "pid", offset=0)
            .select("pid", F.col("prod").alias("pname")))


def load_customers(records: DataFrame, order: str | Sequence[str] = "tid") -> DataFrame:
    """customers(cid, customer, country): first row per name, cid 101..."""
    return (K.dense_key(records, "cust", order, "cid", offset=100, value_cols=["country"])
            .select("cid", F.col("cust").alias("customer"), "country"))


def resolve_keys(staged: DataFrame, products: DataFrame, customers: DataFrame,
                 reps: DataFrame, policy: str = "error") -> DataFrame:
    """Attach pid, cid, rid to every record by natural key."""
    t = staged.withColumn("_rep_no", C.lenient_int("repID", "bigint"))
    t = K.lookup_key(t, customers, "cust", "customer", "cid", policy=policy)
    t = K.lookup_key(t, products, "prod", "pname", "pid", policy=policy)
    t = K.lookup_key(t, reps, "_rep_no", "rid", "rid", policy=policy, raw_col="repID")
    return t.drop("_rep_no")


def load_cust_reps(resolved: DataFrame) -> DataFrame:
    """cust_reps(cid, rid): distinct pairs."""
    return resolved.select("cid", "rid").distinct()


def load_sales(resolved: DataFrame) -> DataFrame:
    """salestxn(tid, date, quantity, amount, ridFK, pidFK, cidFK)."""
    return resolved.select(
        "tid",
        C.parse_us_date("date").alias("date"),
        C.lenient_int("qty").alias("quantity"),
        C.lenient_int("amount").alias("amount"),
        F.col("rid").alias("ridFK"), F.col("pid").alias("pidFK"),
        F.col("cid").alias("cidFK"))


class SalesLoad:
    """The five tables, built on demand from one staging of the records."""

    def __init__(self, txn: DataFrame, rep_records: DataFrame, order_cols: Sequence[str],
                 policy: str = "error", order_source: DataFrame | None = None):
        self._txn, self._reps_raw, self._order_source = txn, rep_records, order_source
        self._order, self._policy = list(order_cols), policy
        self._cache: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._cache:
            self._cache[name] = build()
        return self._cache[name]

    @property
    def records(self):
        """The records as given, with their order columns."""
        extra = [c for c in self._order if c not in TXN_FIELDS]
        return self._txn.select(*extra, *TXN_FIELDS)

    @property
    def staged(self):
        return self._get("staged", lambda: stage_records(self.records, self._order, self._order_source))

    def _source(self):
        """What a dimension is taken from: the numbered records if this load
        has made them, else the records as given."""
        return (self.staged, "tid") if "staged" in self._cache else (self.records, self._order)

    @property
    def products(self):
        return self._get("products", lambda: load_products(*self._source()))

    @property
    def customers(self):
        return self._get("customers", lambda: load_customers(*self._source()))

    @property
    def reps(self):
        return self._get("reps", lambda: load_reps(self._reps_raw))

    def _looked_up(self):
        """Products and customers as the records look them up, written."""
        if "stored" not in self._cache:
            self._cache |= {"products": stored(self.products, "loaded-products"), "customers": stored(self.customers, "loaded-customers"), "stored": True}
        return self.products, self.customers

    @property
    def resolved(self):
        staged = self.staged
        return self._get("resolved", lambda: resolve_keys(staged, *self._looked_up(), self.reps, self._policy))

    @property
    def cust_reps(self):
        if "resolved" in self._cache:
            return load_cust_reps(self.resolved)
        # Distinct natural keys first: a pair's many sales meet the look-ups once.
        keys = self.records.select("cust", "prod", "repID").distinct()
        return load_cust_reps(resolve_keys(keys, *self._looked_up(), self.reps, self._policy))

    @property
    def salestxn(self):
        return load_sales(self.resolved)


def load_all(txn: DataFrame, rep_records: DataFrame, order_cols: Sequence[str],
             policy: str = "error") -> dict[str, DataFrame]:
    """All five tables from one read of the records."""
    s = SalesLoad(txn, rep_records, order_cols, policy)
    return {"products": s.products, "customers": s.customers, "reps": s.reps,
            "cust_reps": s.cust_reps, "salestxn": s.salestxn}
