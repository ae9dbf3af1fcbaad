"""The three dashboard pages as lazy DataFrames over the stored tables.

Each page reads the *current* state of its tables (latest row per key of
the changelog) and returns a dict of panel name -> DataFrame; nothing is
collected until a caller asks for the (small) panel results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from popflow.operators import colors, leaderboard as lbp, performance as perf
from popflow.sources.tables import TableStore


class Dashboard:
    """``guard=True`` refuses to build a page on an empty table (``ValueError``):
    the sink's measures tell, so no data is read for it."""

    def __init__(self, store: TableStore, window: str = "15 seconds", guard: bool = False):
        self.store = store
        self.window = window
        self.guard = guard

    def table(self, name: str, mode: str = "current") -> DataFrame:
        if self.guard:
            measured = self.store.exists(self.store.commits_table(name))
            lbp.require_rows(self.store.commits(name).where("rows > 0") if measured else self.store.table(name), name)
        return self.store.read_table(name, mode)

    def leaderboard_page(self, players=None, start=None, end=None,
                         unit: str = "minutes", k: int = 5) -> dict[str, DataFrame]:
        """Scoreboard, time-picker bounds and the score trend.

        Trend and bounds read the realtime_scores *changelog*, skipping the
        latest-per-key aggregation over the largest table: the changelog
        holds the same keys as the current state (same min/max window), and
        scores are non-negative, so a window's total never decreases and
        its max over all updates is its latest value, which is what the
        trend's max per (window, player) takes. One aggregation instead of
        two, with identical results.
        """
        lb = self.table("leaderboard")
        rs = self.table("realtime_scores", "changelog")
        window_rows = rs
        if start is not None and end is not None:
            window_rows = lbp.in_time_range(rs, start, end, hour_col="window_hour")
        chosen = players if players is not None else lbp.top_players(lb, k)
        return {
            "scoreboard": lbp.scoreboard_top(lb, k),
            "bounds": lbp.time_bounds(rs, lb),
            "trend": lbp.score_trend(window_rows, chosen, unit=unit),
        }

    def color_page(self, player: str, metric: str = "balloon_pops",
                   weight: str = "rows") -> dict[str, DataFrame]:
        cp = self.table("balloon_colored_pops")
        return {
            "players": colors.players(cp),
            "totals": colors.player_totals(cp, player),
            "coverage": colors.color_coverage(cp, player),
            "favorite": colors.favorite_color(cp, player, weight),
            "usage": colors.color_usage(cp, player, weight),
            "least_popular": colors.least_popular_colors(cp, weight=weight),
            "most_popular": colors.most_popular_colors(cp, weight=weight),
            "by_metric": colors.metric_by_color(cp, player, [metric]),
            "metric_total": colors.metric_total(cp, metric, player),
        }

    def performance_page(self, truncate: bool = True) -> dict[str, DataFrame]:
        cpt = self.table("color_performance_trends")
        return {
            "summary": perf.performance_summary(cpt, truncate),
            "distribution": perf.perf_distribution(cpt, truncate),
            "by_color": perf.color_perf_stats(cpt, truncate),
            "avg_by_color": perf.avg_by_color(cpt, truncate),
            "time_summary": perf.time_window_summary(cpt, self.window, truncate),
        }
