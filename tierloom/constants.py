"""They must stay as they are for results to be comparable."""

# Stat names as delivered -> columns of the fact table.
STAT_COLUMNS = {
    "hp": "hp",
    "attack": "attack",
    "defense": "defense",
    "special-attack": "sp_attack",
    "special-defense": "sp_defense",
    "speed": "speed",
}

# Slot number in the type list -> column of the dimension.
TYPE_SLOTS = {1: "primary_type", 2: "secondary_type"}

# Lowest value of each tier; anything below the last one is tier C.
ATTACK_TIERS = ((250, "S"), (200, "A"), (150, "B"))
DEFENSE_TIERS = ((350, "S"), (300, "A"), (250, "B"))
LOWEST_TIER = "C"
TIERS = ("S", "A", "B", "C")

# Move classes.
DAMAGE_CLASSES = ("physical", "special", "status")
DAMAGING_CLASSES = ("physical", "special")

# Moves kept per entity.
MOVES_PER_ENTITY = 3

# Relation -> multiplier and label, strongest multiplier first.
DOCUMENTED_RELATIONS = (
    ("double_damage_to", 2.0, "Super Effective"),
    ("half_damage_to", 0.5, "Not Very Effective"),
    ("no_damage_to", 0.0, "No Effect"),
)
# The same list with the relation name the original model reads for its second entry.
AS_WRITTEN_RELATIONS = (
    ("double_damage_to", 2.0, "Super Effective"),
    ("no_damage_to", 0.5, "Not Very Effective"),
    ("no_damage_to", 0.0, "No Effect"),
)
NEUTRAL_MULTIPLIER = 1.0
NEUTRAL_LABEL = "Normal"
MULTIPLIERS = (0.0, 0.5, 1.0, 2.0)
EFFECT_LABELS = ("No Effect", "Not Very Effective", "Normal", "Super Effective")

# Rarity names.
MYTHICAL = "Mythical"
LEGENDARY = "Legendary"

# Power buckets: exclusive upper bounds, and the two label sets in use.
POWER_BOUNDS = (40, 60, 80, 100, 120)
TILE_POWER_LABELS = ("1: < 40", "2: 40–59", "3: 60–79", "4: 80–99", "5: 100–119", "6: 120+")
APP_POWER_LABELS = ("1: <40", "2: 40-59", "3: 60-79", "4: 80-99", "5: 100-119", "6: 120+")

# Report defaults.
TILE_TOP = 20
TILE_LEGENDARIES = 30
TILE_MOVES = 100
APP_TOP = 25
APP_MOVES = 50
APP_LEGENDARIES = 40
COMPARE_DEFAULT = 3
DEFAULT_STATS = ("attack", "defense", "hp")
