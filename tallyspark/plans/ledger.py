"""The ledger tables as views over the driver's tables.

Line items stand for transactions, customers for donors, suppliers for
committees and nations for candidates. Some keys give null, empty, unknown or
repeated values so that every branch of the rules is met.
"""

from functools import cached_property

from pyspark.sql import functions as F

from ..operators import profile, totals
from ..session import stored

AS_OF = "2001-12-31"
CUTOFF = "1999-01-01"


def _code(prefix, key):
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 8, "0"))


def _cases(*pairs, default=None):
    out = F.when(*pairs[0])
    for test, value in pairs[1:]:
        out = out.when(test, value)
    return out.otherwise(default)


class Ledger:
    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

        self._tables = {}

    def table(self, name):
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def contributions(self):
        li, od = self.table("lineitem"), self.table("orders")
        line = F.col("l_linenumber").cast("long")
        signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(
            F.col("l_extendedprice")
        )
        no_date = (F.col("l_orderkey") % 97 == 0) & (line == 1)
        no_amount = (F.col("l_orderkey") % 101 == 0) & (line == 2)
        return li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("o_custkey").alias("contributor_id"),
            _code("C", F.col("l_suppkey")).alias("cmte_id"),
            F.when(~no_date, F.col("l_shipdate").cast("date")).alias("transaction_dt"),
            F.when(~no_amount, signed.cast("decimal(14,2)")).alias("transaction_amt"),
            F.when(F.col("l_linestatus") == "O", "P").otherwise("G").alias("transaction_pgi"),
            (
                (F.col("l_orderkey") * 10 + line) * 1000000
                + (F.col("l_partkey") * 31 + F.col("l_suppkey") * 7919) % 1000000
            ).alias("sub_id"),
        )

    @cached_property
    def committees(self):
        su, na = self.table("supplier"), self.table("nation")
        key, region = F.col("s_suppkey"), F.col("n_regionkey")
        letters = F.lit("HSPNQOUXYZW")
        return su.join(na, F.col("s_nationkey") == F.col("n_nationkey")).select(
            _code("C", key).alias("cmte_id"),
            F.col("s_name").alias("cmte_nm"),
            F.substr(letters, (key % 11 + 1).cast("int"), F.lit(1)).alias("cmte_tp"),
            F.concat(F.lit("S"), F.char(F.col("n_nationkey") + 65)).alias("cmte_st"),
            _cases(
                (key % 11 == 0, F.lit(None)), (region == 0, "DEM"), (region == 1, "REP"),
                (region == 2, "LIB"), (region == 3, "GRE"), default="IND",
            ).alias("cmte_pty_affiliation"),
        )

    @cached_property
    def candidates(self):
        key, region = F.col("n_nationkey"), F.col("n_regionkey")
        return self.table("nation").select(
            _code("N", key).alias("cand_id"),
            F.col("n_name").alias("cand_name"),
            _cases(
                (key == 9, "CON"), (key == 12, ""), (key == 17, F.lit(None)), (region == 0, "DEM"),
                (region == 1, "REP"), (region == 2, "LBL"), (region == 3, "GRN"), default="IDP",
            ).alias("cand_pty_affiliation"),
            F.substr(F.lit("PSH"), (key % 3 + 1).cast("int"), F.lit(1)).alias("cand_office"),
            F.concat(F.lit("S"), F.char(key + 65)).alias("cand_office_st"),
            (F.lit(2000) + key % 3 * 2).cast("int").alias("cand_election_yr"),
        )

    @cached_property
    def links(self):
        su = self.table("supplier")
        key, nation = F.col("s_suppkey"), F.col("s_nationkey")

        def link(rows, to):
            return rows.select(
                _code("C", key).alias("cmte_id"), _code("N", to).alias("cand_id"),
                F.lit(2000).alias("cand_election_yr"),
            )

        own = link(su.where(key % 7 != 0), nation)
        return own.unionByName(link(su.where(key % 5 == 0), (nation + 1) % 25))

    @cached_property
    def identities(self):
        """Donor rows before any transaction is looked at."""
        cu = self.table("customer")
        key = F.col("c_custkey")
        state = _cases(
            (key % 53 == 0, F.lit(None)), (key % 59 == 0, ""), (key % 61 == 0, "ZZZ"),
            default=F.concat(F.lit("S"), F.char(F.col("c_nationkey") + 65)),
        )
        return cu.select(
            key.alias("id"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("F"), (key % 7).cast("string")).alias("first_name"),
            F.concat(F.lit("CITY"), (key % 40).cast("string")).alias("city"),
            state.alias("state"),
            F.when(key % 47 != 0, F.lpad((key * 37 % 1000 * 91).cast("string"), 5, "0")).alias("zip_code"),
            _cases(
                (key % 41 == 0, F.lit(None)), (key % 43 == 0, ""), (key % 19 == 0, "SELF"),
                (key % 23 == 0, "NONE"),
                default=F.concat(F.lit("Employer "), (key * key % 211).cast("string")),
            ).alias("employer"),
            _cases(
                (key % 37 == 0, F.lit(None)), (key % 29 == 0, " information requested "),
                (key % 31 == 0, "INFORMATION REQUESTED"), (key % 13 == 0, "SELF EMPLOYED"),
                default=F.concat(F.col("c_mktsegment"), F.lit(" "), (key % 30).cast("string")),
            ).alias("occupation"),
        )

    @cached_property
    def profile(self):
        return profile.donor_profile(
            self.contributions, self.committees, self.links, self.candidates, AS_OF
        )

    @cached_property
    def donors(self):
        """The donor table: written once per session, as many queries start from it."""
        return stored(profile.update_donors(self.identities, self.profile), "donors")

    @cached_property
    def totals(self):
        return totals.donor_totals(
            self.contributions, self.committees, self.links, self.candidates, AS_OF
        )
