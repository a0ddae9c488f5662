"""The fitted recommender: feature lists per position group plus the tables.

``fit`` runs the one correlation pass and collects only the chosen feature
names (at most 3 x 12 strings); every query method returns a lazy DataFrame
with the club or player filter pushed below the scoring.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from ..operators import batch as B
from ..operators import matrix as M
from ..operators.votes import feature_votes, group_features
from ..schema import FEATURES, RATINGS, SCORE_SCALE, normalize_group
from ..sources.views import club_means


@dataclass
class ScoutModel:
    players: DataFrame
    teams: DataFrame
    groups: dict[str, list[str]] = field(default_factory=dict)
    on_zero: str = "error"
    n_clubs: int | None = None
    digits: int | None = SCORE_SCALE   # scores equal to so many decimals are ties; None ranks raw scores
    all_features: list[str] = field(default_factory=lambda: list(FEATURES))

    def features(self, group: str) -> list[str]:
        if group.upper() == "ALL":
            return list(self.all_features)
        return self.groups[normalize_group(group)]

    def _label(self, group: str) -> str:
        return "ALL" if group.upper() == "ALL" else normalize_group(group)

    def mvp_for_team(self, team: str, position: str, k: int | None = 10, reverse: bool = False,
                     eligible_group: str | None = None, exclude_own: bool = False, strict: bool = False) -> DataFrame:
        return M.mvp_for_team(self.players, self.teams, team, self.features(position), self._label(position),
                              k, reverse, self.on_zero, eligible_group, exclude_own, strict, self.digits)

    def mvt_for_player(self, position: str, player_id=None, name: str | None = None, k: int | None = 10,
                       reverse: bool = False, strict: bool = False) -> DataFrame:
        return M.mvt_for_player(self.players, self.teams, self.features(position), self._label(position),
                                player_id, name, k, reverse, self.on_zero, strict, self.digits)

    def worst_in_club(self, position: str, team: str) -> DataFrame:
        return M.worst_in_club(self.players, self.teams, team, position, self.features(position), self.on_zero, self.digits)

    def lvp_from_list(self, ids, team: str) -> DataFrame:
        return M.lvp_from_list(self.players, self.teams, team, ids, self.all_features, self.on_zero, self.digits)

    def all_groups(self) -> dict[str, list[str]]:
        return {**self.groups, "ALL": list(self.all_features)}

    def matrix(self) -> DataFrame:
        return M.matrix_scores(self.players, self.teams, self.all_groups(), self.on_zero, n_clubs=self.n_clubs)

    def mvp_all_clubs(self, k: int = 10, reverse: bool = False, method: str = "batch") -> DataFrame:
        fn = B.mvp_all_clubs if method == "batch" else M.mvp_all_clubs
        return fn(self.players, self.teams, self.all_groups(), k, reverse, self.on_zero, self.n_clubs, digits=self.digits)

    def mvt_all_players(self, k: int = 10, reverse: bool = False, method: str = "batch") -> DataFrame:
        fn = B.mvt_all_players if method == "batch" else M.mvt_all_players
        return fn(self.players, self.teams, self.all_groups(), k, reverse, self.on_zero, self.n_clubs, digits=self.digits)


def fit(players: DataFrame, teams: DataFrame | None = None, on_zero: str = "error",
        method: str = "auto", features=FEATURES, ratings=RATINGS, digits: int | None = SCORE_SCALE) -> ScoutModel:
    """Vote the features of each position group (``ratings`` are the per-position
    rating columns, ``features`` the candidate features) and keep the tables."""
    features, ratings = list(features), list(ratings)
    teams = club_means(players, features) if teams is None else teams
    groups = group_features(feature_votes(players, ratings, features, method=method))
    return ScoutModel(players, teams, groups, on_zero, teams.count(), digits, features)


def recommend(model: ScoutModel, player=None, team: str | None = None, position: str = "DEF",
              k: int | None = 10, reverse: bool = False) -> DataFrame:
    """Clubs for a player, players for a club; at least one of them is required."""
    if player is None and team is None:
        raise RuntimeError("recommend() needs a player, a team, or both")
    if team is not None:
        return model.mvp_for_team(team, position, k, reverse)
    if isinstance(player, str):
        return model.mvt_for_player(position, name=player, k=k, reverse=reverse)
    return model.mvt_for_player(position, player_id=player, k=k, reverse=reverse)
