"""Game configuration: colour prices and character favourites.

These are the scoring dimensions. They are configuration, not data: their
size is fixed by the game definition (a dozen colours, a few dozen
characters), which is what lets the scoring operator inline them as map
literals instead of joining a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values (must equal the reference game definition) ---------------
# Base points per balloon colour.
COLOR_POINTS: dict[str, int] = {
    "red": 100,
    "blue": 75,
    "green": 60,
    "yellow": 50,
    "purple": 40,
    "brown": 35,
    "orange": 45,
    "pink": 55,
    "gold": 90,
    "grey": 70,
    "white": 80,
}

# Favourite colours per character, in listing order (position = char_id).
CHARACTER_FAVORITES: dict[str, list[str]] = {
    "Jerry": ["brown", "yellow"],
    "Tom": ["grey", "blue"],
    "Mickey": ["red", "black"],
    "Donald": ["blue", "white"],
    "Bugs_Bunny": ["grey", "orange"],
    "Daffy_Duck": ["black", "orange"],
    "SpongeBob": ["yellow", "brown"],
    "Patrick": ["pink", "green"],
    "Pikachu": ["yellow", "red"],
    "Mario": ["red", "blue"],
    "Sonic": ["blue", "gold"],
    "Woody": ["brown", "yellow"],
    "Buzz": ["green", "purple"],
    "Scooby": ["brown", "green"],
    "Popeye": ["blue", "red"],
    "Pink_Panther": ["pink", "purple"],
    "Road_Runner": ["blue", "purple"],
    "Tweety": ["yellow", "orange"],
}

# Width of the three windowed views.
DEFAULT_WINDOW = "15 seconds"
# Multiplier applied to the base points on a favourite-colour hit.
BONUS_MULTIPLIER = 2
# --- end of fixed values ----------------------------------------------------


@dataclass(frozen=True)
class GameConfig:
    colors: dict[str, int] = field(default_factory=lambda: dict(COLOR_POINTS))
    favorites: dict[str, list[str]] = field(
        default_factory=lambda: {k: list(v) for k, v in CHARACTER_FAVORITES.items()}
    )
    bonus_multiplier: int = BONUS_MULTIPLIER

    @property
    def characters(self) -> list[str]:
        return list(self.favorites)


DEFAULT_CONFIG = GameConfig()
