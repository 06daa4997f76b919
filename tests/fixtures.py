"""Documents of a tiny world, with every edge row the pipeline must get right."""

from __future__ import annotations

ADDRESS = "https://example.org/api"


def entity(id, name, stats=(), types=(), abilities=(), moves=(), species=None, **other):
    document = {
        "id": id,
        "name": name,
        "base_experience": None,
        "height": 7,
        "weight": 69,
        "is_default": True,
        "order": id,
        "species": None if species is None else {"name": f"s{species}", "url": f"{ADDRESS}/species/{species}/"},
        "stats": [{"base_stat": v, "effort": 1, "stat": {"name": k}} for k, v in dict(stats).items()],
        "types": [{"slot": slot, "type": {"name": kind}} for slot, kind in types],
        "abilities": [{"is_hidden": h, "slot": slot, "ability": {"name": a}} for a, h, slot in abilities],
        "moves": [{"move": {"name": move}} for move in moves],
    }
    return {**document, **other}


def stats(hp, attack, defense, sp_attack=50, sp_defense=50, speed=50):
    return {
        "hp": hp,
        "attack": attack,
        "defense": defense,
        "special-attack": sp_attack,
        "special-defense": sp_defense,
        "speed": speed,
    }


ENTITIES = [
    entity(1, "ember", stats(100, 149, 149), [(1, "fire"), (2, "air")], [("glow", False, 1), ("haze", True, 3)],
           ["flare", "gust", "jab", "slam", "stare", "unknown"], species=1),
    entity(2, "brook", stats(100, 150, 150), [(1, "water")], [], ["splash", "flare"], species=2),
    entity(3, "cliff", stats(100, 199, 199), [(2, "rock"), (1, "earth"), (3, "extra")], [], ["slam"], species=3),
    entity(4, "dune", stats(150, 200, 150), [], [], ["slam", "jab"], species=4),
    entity(5, "echo", stats(149, 249, 200), [(1, "air")], [], [], species=None),
    entity(6, "frost", stats(150, 250, 200), [(1, "water")], [], ["splash"], species=None),
    # Same attack and special attack as entity 6: the id decides.
    entity(7, "gale", stats(0, 250, 90), [(1, "air"), (2, "fire")], [], ["flare"], species=1),
    # No attack value, and a zero attack: neither is ranked as an attacker.
    entity(8, "haze", {"hp": 10, "defense": 10, "speed": 5}, [(1, "air")], [], [], species=2),
    entity(9, "ink", stats(10, 0, 10), [(1, "water")], [], [], species=5),
    # Equal attack, one without special attack, which sorts first.
    entity(10, "jade", {"attack": 180, "hp": 1, "defense": 1}, [(1, "earth")], [], [], species=4),
    entity(11, "kelp", stats(1, 180, 1, sp_attack=10), [(1, "water")], [], [], species=4),
    # Lists absent altogether.
    {k: v for k, v in entity(12, "loam", species=5).items() if k not in ("stats", "types", "abilities", "moves")},
]


def move(id, name, power, accuracy, kind, damage_class, **other):
    document = {"id": id, "name": name, "accuracy": accuracy, "power": power, "pp": 10, "effect_chance": None,
                "type": {"name": kind}, "damage_class": {"name": damage_class}}
    return {**document, **other}


MOVES = [
    move(1, "flare", 90, 100, "fire", "special"),
    move(2, "gust", 40, 100, "air", "special"),
    move(3, "jab", 39, 95, "earth", "physical"),
    move(4, "slam", 80, 75, "rock", "physical"),
    move(5, "stare", None, 100, "air", "status"),
    move(6, "splash", 120, None, "water", "special"),
    move(7, "drain", None, None, "water", "special"),
    *[
        move(20 + i, f"edge{power}", power, 50, "rock", "physical")
        for i, power in enumerate((39, 40, 59, 60, 79, 80, 99, 100, 119, 120))
    ],
]


def species(id, legendary=False, mythical=False, habitat="sea", shape="round"):
    return {
        "id": id,
        "name": f"s{id}",
        "capture_rate": 45,
        "base_happiness": None,
        "is_legendary": legendary,
        "is_mythical": mythical,
        "generation": {"name": f"generation-{id % 2}"},
        "habitat": None if habitat is None else {"name": habitat},
        "shape": None if shape is None else {"name": shape},
    }


SPECIES = [
    species(1, legendary=True),
    species(2, mythical=True),
    species(3, legendary=True, mythical=True),
    species(4, habitat=None),
    species(5, shape=None),
]


def relations(id, name, **lists):
    targets = {
        relation: [{"name": target, "url": f"{ADDRESS}/type/{target}/"} for target in names]
        for relation, names in lists.items()
    }
    return {"id": id, "name": name, "damage_relations": targets}


TYPES = [
    relations(1, "fire", double_damage_to=["earth"], half_damage_to=["water"], no_damage_to=["air"]),
    relations(2, "water", double_damage_to=["fire", "void"], half_damage_from=["fire"]),
    relations(3, "air", no_damage_to=["earth"], double_damage_to=[]),
    relations(4, "earth", half_damage_from=["fire"]),
    # No targets at all: delivered, but without rows and not on the axis.
    relations(5, "rock", double_damage_to=[], no_damage_to=[]),
]


def land_all(land) -> str:
    land("entity", ENTITIES)
    land("move", MOVES)
    land("species", SPECIES)
    return land("type", TYPES)
