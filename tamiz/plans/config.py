"""Validated plan parameters (U3): a bad value fails before any data is read."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

CANONICAL = ("nombre", "cuil", "telefono", "localidad", "origen", "fecha_carga")

# Demo coverage zone, filler sequences and names, header synonyms.
ZONE = ("Castelar", "Haedo", "Moron", "Hurlingham", "Ituzaingo", "Ramos Mejia", "Villa Luzuriaga", "San Justo")
FILLER_SEQUENCES = ("1234567890", "0123456789", "0987654321", "1234512345", "1212121212")
FILLER_NAMES = ("test", "asdf", "qwerty", "xxx", "prueba", "sin nombre", "nn", "na", "n/a", "ninguno", "sin dato")
SYNONYMS = {
    "nombre": ("nombre", "nombre y apellido", "apellido y nombre", "nombre completo", "contacto"),
    "cuil": ("cuil", "cuit", "cuil/cuit", "nro de cuil", "numero de cuil"),
    "telefono": ("telefono", "tel", "telefono celular", "celular", "movil", "nro de telefono", "numero de telefono", "telefono de contacto"),
    "localidad": ("localidad", "ciudad", "partido", "zona", "barrio"),
    "origen": ("origen", "origen del lead", "fuente", "canal"),
    "fecha_carga": ("fecha_carga", "fecha de carga", "fecha de alta", "fecha alta", "fecha de ingreso", "fecha"),
}


class ConfigError(ValueError):
    """A plan parameter that can't be used."""


@dataclass(frozen=True)
class Scoring:
    """Points of the additive score and its thresholds; a value without an entry counts 0."""

    # Weights and thresholds of the score.
    phone: dict[str, int] = field(default_factory=lambda: {"celular": 30, "fijo": 10, "ambiguo": 18})
    taxid_valid: int = 15
    taxid_invalid: int = -10
    in_zone: int = 20
    freshness: dict[str, int] = field(default_factory=lambda: {"alta": 25, "media": 15, "baja": 5, "fria": 0, "sin dato": 0})
    origin: dict[str, int] = field(default_factory=lambda: {"referido": 15, "formulario web": 10, "evento": 10, "campaña Meta": 5, "base propia": 0})
    high: int = 70
    medium: int = 40


@dataclass(frozen=True)
class Segment:
    label: bool = False
    discard: str | None = None

    def __post_init__(self):
        if not isinstance(self.label, bool):
            raise ConfigError(f"etiquetar must be true or false, not {self.label!r}")
        if self.discard not in (None, "fisica", "juridica"):
            raise ConfigError(f"descartar must be null, fisica or juridica, not {self.discard!r}; an unknown person type is never discarded")

    @property
    def active(self) -> bool:
        return self.label or self.discard is not None


@dataclass(frozen=True)
class Filler:
    tail: int = 7
    sequences: tuple[str, ...] = FILLER_SEQUENCES
    names: tuple[str, ...] = FILLER_NAMES

    def __post_init__(self):
        if isinstance(self.tail, bool) or not isinstance(self.tail, int) or not 4 <= self.tail <= 10:
            raise ConfigError(f"min_digitos_iguales_al_final must be 4 to 10, not {self.tail!r}")
        for s in self.sequences:
            if not (isinstance(s, str) and len(s) == 10 and s.isascii() and s.isdigit()):
                raise ConfigError(f"a filler sequence has ten digits, not {s!r}")
        for n in self.names:
            if not isinstance(n, str) or not n.strip():
                raise ConfigError(f"a filler name is a non-empty text, not {n!r}")


@dataclass(frozen=True)
class OptOut:
    reason: str = "opt-out del cliente"

    def __post_init__(self):
        if not isinstance(self.reason, str) or "opt-out" not in self.reason:
            raise ConfigError(f"the reason must contain 'opt-out', the report counts by it; got {self.reason!r}")


def check_mapping(mapping: dict[str, str] | None) -> dict[str, str]:
    """{client header: canonical name}; keys that start with _ are comments."""
    kept = {k: v for k, v in (mapping or {}).items() if not k.startswith("_")}
    for k, v in kept.items():
        if v not in CANONICAL:
            raise ConfigError(f"column {k!r} is mapped to {v!r}, which is not one of {', '.join(CANONICAL)}")
    return kept


def read_json(path: str | Path) -> dict:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def segment_from(path: str | Path) -> Segment:
    c = read_json(path)
    return Segment(c.get("etiquetar", False), c.get("descartar"))


def filler_from(path: str | Path) -> Filler:
    c = read_json(path)
    tel, names = c.get("telefonos", {}), c.get("nombres", {})
    return Filler(tel.get("min_digitos_iguales_al_final", 7), tuple(tel.get("secuencias", FILLER_SEQUENCES)), tuple(names.get("relleno", FILLER_NAMES)))


def synonyms_from(path: str | Path) -> dict[str, tuple[str, ...]]:
    return {k: tuple(v) for k, v in read_json(path).items() if not k.startswith("_")}


@dataclass(frozen=True)
class PlanConfig:
    cutoff: str | None = None
    zone: tuple[str, ...] = ZONE
    scoring: Scoring = field(default_factory=Scoring)
    filler: Filler = field(default_factory=Filler)
    segment: Segment = field(default_factory=Segment)
    optout: OptOut = field(default_factory=OptOut)
