"""Football source tables derived from the TPC-H-like tables.

Every output row comes from rows of the given tables, so the work of each
query grows with them.  Only column expressions, one aggregate per fact and
equi-joins are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.exprs import MONEY
from touchline.schemas import RAW, RAW_TABLES

# Nations without an entry in the competition dictionary, so that
# games refer to competitions it does not know.
UNPUBLISHED = ("NATION_7", "NATION_14", "NATION_21")

# Declared columns of the given tables.
SCANS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_nationkey int",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def _name(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _club_name(key: Column) -> Column:
    return F.concat(F.lit("Supplier#"), F.lpad(key.cast("string"), 9, "0"))


# Part types as positions; promotional parts have one that no label table knows.
POSITIONS = {"STANDARD": "Attack", "SMALL": "Defender", "MEDIUM": "Midfield", "LARGE": "Goalkeeper", "ECONOMY": "Missing"}
# Nations whose competition carries a code of the short-name table.
CODES = {1: "IT1", 2: "ES1", 3: "GB1"}


def _coded(key: Column, codes: dict) -> Column:
    text = key.cast("string")
    for known, code in codes.items():
        text = F.when(key == known, code).otherwise(text)
    return text


def _position(kind: Column) -> Column:
    return _coded(kind, POSITIONS)


def _competition(key: Column) -> Column:
    return _coded(key, CODES)


class DriverTables:
    """Lazily built raw tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self._made: dict[str, DataFrame] = {}
        self._scans: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in RAW_TABLES:
            raise KeyError(name)
        if name not in self._made:
            df = getattr(self, "_" + name)()
            self._made[name] = df.selectExpr(*[
                f"cast({f.name} as {f.dataType.simpleString()}) as {f.name}" for f in RAW[name]
            ])
        return self._made[name]

    def _read(self, name: str) -> DataFrame:
        if name not in self._scans:
            # A declared schema spares the job that would infer it.
            self._scans[name] = self.spark.read.schema(SCANS[name]).parquet(f"{self.root}/{name}.parquet")
        return self._scans[name]

    def most_rows(self) -> int:
        """Rows of the largest table, from the files' footers."""
        return max(self._read(name).count() for name in ("orders", "lineitem", "events"))

    def _club_total(self) -> DataFrame:
        return self._read("supplier").agg(F.count("*").alias("n_clubs"))

    # -- reference data -----------------------------------------------------

    def _players(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        words = F.split("p_name", " ")
        return (
            self._read("part").where(size > 2).crossJoin(F.broadcast(self._club_total()))
            .select(
                key.alias("player_id"),
                words[0].alias("first_name"),
                words[1].alias("last_name"),
                F.concat(F.lit("  "), F.col("p_name"), F.lit("\t")).alias("name"),
                (1995 + size % 7).alias("last_season"),
                (key % F.col("n_clubs")).alias("current_club_id"),
                F.col("p_type").alias("country_of_birth"),
                F.lit(None).alias("city_of_birth"),
                F.when(size % 10 != 0, _name("Country ", size % 25)).alias("country_of_citizenship"),
                F.date_add(F.lit("1960-01-01").cast("date"), size * 400).alias("date_of_birth"),
                F.col("p_brand").alias("sub_position"),
                _position(F.col("p_type")).alias("position"),
                F.when(size % 3 == 0, "left").when(size % 3 == 1, "right").alias("foot"),
                F.when(size % 9 == 0, 0).otherwise(150 + size).alias("height_in_cm"),
                F.date_add(F.lit("2001-06-30").cast("date"), size * 10).alias("contract_expiration_date"),
                F.when(size % 5 != 0, F.col("p_brand")).alias("agent_name"),
                size.alias("international_caps"),
                (size % 10).alias("international_goals"),
                (size % 25).alias("current_national_team_id"),
                _competition(size % 25).alias("current_club_domestic_competition_id"),
                F.when(size % 4 != 0, _club_name(key % F.col("n_clubs"))).alias("current_club_name"),
                F.when(size % 8 != 0, F.floor(F.col("p_retailprice") * 1000)).alias("market_value_in_eur"),
                F.floor(F.col("p_retailprice") * 1500).alias("highest_market_value_in_eur"),
            )
        )

    def _clubs(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self._read("supplier").where("s_acctbal >= 0").select(
            key.alias("club_id"),
            F.lower("s_name").alias("club_code"),
            F.concat(F.lit(" "), F.col("s_name")).alias("name"),
            _competition(F.col("s_nationkey")).alias("domestic_competition_id"),
            (F.floor(F.col("s_acctbal")) * 1000).alias("total_market_value"),
            (20 + key % 15).alias("squad_size"),
            (20 + key % 12).alias("average_age"),
            F.when(key % 6 != 0, key % 12).alias("foreigners_number"),
            (key % 12 * 5).alias("foreigners_percentage"),
            (key % 7).alias("national_team_players"),
            F.when(key % 4 != 0, _name("Stadium ", key)).alias("stadium_name"),
            F.when(key % 8 != 0, 10000 + key % 50 * 100).alias("stadium_seats"),
            _name("net ", key % 9).alias("net_transfer_record"),
            F.when(key % 3 != 0, _name("Coach ", key)).alias("coach_name"),
            F.lit(2001).alias("last_season"),
        )

    def _nations(self) -> DataFrame:
        region = self._read("region")
        nation = self._read("nation")
        return nation.join(region, nation.n_regionkey == region.r_regionkey)

    def _competitions(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._nations().where(~F.col("n_name").isin(*UNPUBLISHED)).select(
            _competition(key).alias("competition_id"),
            F.lower("n_name").alias("competition_code"),
            F.concat(F.lit(" "), F.col("n_name"), F.lit(" ")).alias("name"),
            F.lit("first_tier").alias("sub_type"),
            F.when(key % 3 == 0, "domestic_cup").otherwise("domestic_league").alias("type"),
            key.alias("country_id"),
            F.col("n_name").alias("country_name"),
            _name("L", key).alias("domestic_league_code"),
            F.col("r_name").alias("confederation"),
            F.when(key % 4 != 0, 10 + key).alias("total_clubs"),
        )

    def _countries(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._nations().select(
            key.alias("country_id"),
            F.col("n_name").alias("country_name"),
            _name("C", key).alias("country_code"),
            F.concat(F.col("r_name"), F.lit(" ")).alias("confederation"),
            (10 + key).alias("total_clubs"),
            (100 + key * 7).alias("total_players"),
            (20 + key % 9).alias("average_age"),
        )

    def _national_teams(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._nations().select(
            key.alias("national_team_id"),
            F.when(key % 5 != 0, F.col("n_name")).alias("name"),
            _name("T", key).alias("team_code"),
            key.alias("country_id"),
            F.col("n_name").alias("country_name"),
            _name("C", key).alias("country_code"),
            F.col("r_name").alias("confederation"),
            (20 + key % 6).alias("squad_size"),
            (22 + key % 8).alias("average_age"),
            (key % 5).alias("foreigners_number"),
            (key % 5 * 4).alias("foreigners_percentage"),
            F.when(key % 6 != 0, key * 1000000).alias("total_market_value"),
            _name("Selector ", key).alias("coach_name"),
            F.when(key % 7 != 0, 1 + key).alias("fifa_ranking"),
            F.lit(2001).alias("last_season"),
        )

    # -- matches ------------------------------------------------------------

    def _games(self) -> DataFrame:
        key, n = F.col("o_orderkey"), F.col("n_clubs")
        formations = F.array(F.lit("4-4-2"), F.lit("4-3-3"), F.lit("3-5-2"), F.lit(None))
        home = F.col("o_custkey") % n
        based = (
            self._read("orders")
            .join(self._read("customer").select("c_custkey", "c_nationkey"),
                  F.col("o_custkey") == F.col("c_custkey"))
            .crossJoin(F.broadcast(self._club_total()))
            .select("*", home.alias("home"), ((home + 1 + key % (n - 1)) % n).alias("away"))
        )
        year = F.year("o_orderdate")
        return based.select(
            key.alias("game_id"),
            _competition(F.col("c_nationkey")).alias("competition_id"),
            year.alias("season"),
            F.concat(F.lit(" "), F.col("o_orderpriority")).alias("round"),
            F.to_date("o_orderdate").alias("date"),
            F.col("home").alias("home_club_id"),
            F.col("away").alias("away_club_id"),
            (key % 5).alias("home_club_goals"),
            (F.floor(key / 5) % 4).alias("away_club_goals"),
            F.when(key % 6 != 0, key % 20 + 1).alias("home_club_position"),
            F.when(key % 7 != 0, key % 18 + 1).alias("away_club_position"),
            F.when(key % 11 != 0, _name("Manager ", F.col("home") % 2 + year % 3)).alias("home_club_manager_name"),
            F.when(key % 12 != 0, _name("Manager ", F.col("away") % 2 + year % 3)).alias("away_club_manager_name"),
            F.concat(F.lit(" Ground "), F.col("home").cast("string")).alias("stadium"),
            F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).alias("attendance"),
            _name("Referee ", key % 40).alias("referee"),
            formations[(key % 4).cast("int")].alias("home_club_formation"),
            formations[(F.floor(key / 4) % 4).cast("int")].alias("away_club_formation"),
            F.when(key % 13 != 0, _club_name(F.col("home"))).alias("home_club_name"),
            F.when(key % 14 != 0, _club_name(F.col("away"))).alias("away_club_name"),
            F.concat((key % 5).cast("string"), F.lit(":"), (F.floor(key / 5) % 4).cast("string")).alias("aggregate"),
            F.lit("domestic_league").alias("competition_type"),
        )

    def _club_games(self) -> DataFrame:
        def side(own: str, other: str) -> Column:
            return F.struct(
                F.col(f"{own}_club_id").alias("club_id"),
                F.col(f"{own}_club_goals").alias("own_goals"),
                F.col(f"{own}_club_position").alias("own_position"),
                F.col(f"{own}_club_manager_name").alias("own_manager_name"),
                F.col(f"{other}_club_id").alias("opponent_id"),
                F.col(f"{other}_club_goals").alias("opponent_goals"),
                F.col(f"{other}_club_position").alias("opponent_position"),
                F.col(f"{other}_club_manager_name").alias("opponent_manager_name"),
                F.lit(f" {own} ").alias("hosting"),
                (F.col(f"{own}_club_goals") > F.col(f"{other}_club_goals")).cast("long").alias("is_win"),
            )

        return self["games"].select(
            "game_id", F.explode(F.array(side("home", "away"), side("away", "home"))).alias("s")
        ).select("game_id", "s.*")

    def _lines(self, where: str | None = None) -> DataFrame:
        """Line items collapsed to one row per order and part, joined to the game."""
        lines = self._read("lineitem")
        if where:
            lines = lines.where(where)
        lines = lines.groupBy("l_orderkey", "l_partkey").agg(
            F.sum("l_quantity").cast("long").alias("minutes"),
            F.max("l_linenumber").alias("top_line"),
            F.min("l_linenumber").alias("low_line"),
            F.min("l_suppkey").alias("low_supp"),
            F.count("*").alias("lines"),
        )
        games = self["games"].select(
            "game_id", "date", "competition_id", "home_club_id", "away_club_id"
        )
        return lines.join(games, F.col("l_orderkey") == F.col("game_id")).withColumn(
            "club", F.when(F.col("low_supp") % 2 == 0, F.col("home_club_id")).otherwise(F.col("away_club_id"))
        )

    def _appearances(self) -> DataFrame:
        player = F.col("l_partkey")
        return self._lines().select(
            F.concat(F.col("game_id").cast("string"), F.lit("_"), player.cast("string")).alias("appearance_id"),
            "game_id",
            player.alias("player_id"),
            F.col("club").alias("player_club_id"),
            F.when(F.col("low_supp") % 5 == 0, F.lit(-1)).otherwise(F.col("club")).alias("player_current_club_id"),
            "date",
            F.when(player % 17 != 0, _name(" Player ", player)).alias("player_name"),
            "competition_id",
            (F.col("lines") % 2).alias("yellow_cards"),
            (F.col("lines") - 1).alias("red_cards"),
            (F.col("top_line") % 3).alias("goals"),
            (F.col("low_line") % 2).alias("assists"),
            F.col("minutes").alias("minutes_played"),
        )

    def _game_lineups(self) -> DataFrame:
        player = F.col("l_partkey")
        return self._lines("l_linestatus = 'F'").select(
            F.concat(F.lit(" L"), F.col("game_id").cast("string"), F.lit("_"), player.cast("string")).alias("game_lineups_id"),
            "date",
            "game_id",
            player.alias("player_id"),
            F.col("club").alias("club_id"),
            _name("Player ", player).alias("player_name"),
            F.when(F.col("minutes") % 2 == 0, " Starting_Lineup").otherwise("Substitutes ").alias("type"),
            F.when(F.col("low_line") % 4 == 0, "").otherwise(F.concat(F.lit("role "), F.col("low_line").cast("string"))).alias("position"),
            F.col("top_line").cast("string").alias("number"),
            (F.col("minutes") % 11 == 0).cast("long").alias("team_captain"),
        )

    def _game_events(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self._read("events").crossJoin(F.broadcast(self._club_total()))
            .select(
                F.concat(F.lit("E"), F.col("event_id").cast("string"), F.lit(" ")).alias("game_event_id"),
                F.to_date("ts").alias("date"),
                F.col("event_id").alias("game_id"),
                F.when(kind == "error", F.lit(-1)).otherwise(F.minute("ts")).alias("minute"),
                F.upper(kind).alias("type"),
                (F.col("user_id") % F.col("n_clubs")).alias("club_id"),
                _club_name(F.col("user_id") % F.col("n_clubs")).alias("club_name"),
                F.col("user_id").alias("player_id"),
                F.when(kind == "view", " ").otherwise(F.col("props")).alias("description"),
                F.when(kind == "click", F.col("user_id") + 1).alias("player_in_id"),
                F.when(kind == "purchase", F.col("user_id") + 2).alias("player_assist_id"),
            )
        )

    # -- market -------------------------------------------------------------

    def _player_valuations(self) -> DataFrame:
        club = F.col("l_suppkey")
        return self._read("lineitem").where("l_returnflag <> 'R'").select(
            F.col("l_partkey").alias("player_id"),
            F.to_date("l_shipdate").alias("date"),
            F.floor(F.col("l_extendedprice") * 300).alias("market_value_in_eur"),
            F.when(F.col("l_linenumber") != 3, _club_name(club)).alias("current_club_name"),
            F.when(F.col("l_discount") > 0.005, club).alias("current_club_id"),
            F.when(F.col("l_tax") > 0.005, _competition((F.col("l_partkey") + club % 2) % 25))
            .alias("player_club_domestic_competition_id"),
        )

    def _transfers(self) -> DataFrame:
        player, line = F.col("l_partkey"), F.col("l_linenumber")
        source = F.col("l_suppkey")
        target = (source + line) % F.col("n_clubs")
        price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
        # Most fees lie near the value of 300; the largest quantities carry a high premium.
        rate = F.when(quantity >= 48, 420.0).otherwise(220 + quantity * 3)
        return (
            self._read("lineitem").where("l_returnflag = 'R'")
            .crossJoin(F.broadcast(self._club_total()))
            .select(
                player.alias("player_id"),
                F.to_date("l_shipdate").alias("transfer_date"),
                F.concat(F.lit(" "), F.year("l_shipdate").cast("string")).alias("transfer_season"),
                source.alias("from_club_id"),
                target.alias("to_club_id"),
                F.when(line != 5, _club_name(source)).alias("from_club_name"),
                F.when(line != 4, _club_name(target)).otherwise("").alias("to_club_name"),
                F.when(
                    F.col("l_discount") > 0.005,
                    F.when(line == 7, F.lit(0)).otherwise(F.floor(price * rate)),
                ).cast(MONEY).alias("transfer_fee"),
                F.when(
                    F.col("l_tax") > 0.015,
                    F.when(F.col("l_quantity") == 50, F.lit(0)).otherwise(F.floor(price * 300)),
                ).cast(MONEY).alias("market_value_in_eur"),
                F.when(player % 19 != 0, _name("Player ", player)).alias("player_name"),
            )
        )
