"""Run configuration: every id, label and code of the sync is a parameter.

Ids, labels and codes of a tracker have no defaults here: the caller gives them, from a
JSON file on the command line (:func:`SyncConfig.from_file`).  The values the fixtures
use are ``sources.fixtures.FIXTURE_CONFIG``.  Nothing here is a credential or a
connection string.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class ElementVocabulary:
    """Patterns that classify registry elements (kind matched by ILIKE, note by LIKE).

    Fixed values: the element vocabulary of the registry, as it must be matched.
    """

    cr: str = "%CR%"
    other: str = "OTROS"
    arq: str = "%Arq%"
    arm: str = "%ARM%"
    pole: str = "%POSTE%"
    canal: str = "%CANAL%"
    note_cr: str = "%CR%"
    uso_zero: str = "0"


@dataclass(frozen=True, kw_only=True)
class SeedDefaults:
    """Constant columns of an item seeded from the registry."""

    type_id: int
    project_id: int
    status_id: int
    priority_id: int
    author_id: int
    lock_version: int = 0
    description: str = ""
    schedule_manually: bool = False
    ignore_non_working_days: bool = False


def _tuples(value):
    return tuple(map(_tuples, value)) if isinstance(value, list) else value


@dataclass(frozen=True, kw_only=True)
class SyncConfig:
    entity_type: str
    dossier_type: int
    request_type: int
    seed: SeedDefaults
    operator_id: int
    # key prefixes: excluded from seeding / required for the history read (None = no filter)
    seed_exclude_prefix: str | None = None
    history_prefix: str | None = None
    # JSON keys of one state-history entry
    history_state_key: str
    history_date_key: str
    # True: malformed JSON fails the run (as the original transaction did); False: NULL
    strict_json: bool = True
    # routing
    partner_label: str
    partner_field_id: int
    request_suffix: str
    suffix_word: str
    ref_field_id: int
    relation_type: str
    # due date
    state_field_id: int
    due_label: str
    # value rewrites
    float_format: str
    recode_field_id: int
    recode_map: tuple[tuple[str, str], ...]
    # classification by presence of two fields
    class_field_id: int
    probe_a_field_id: int
    probe_b_field_id: int
    code_only_a: str
    code_only_b: str
    code_none: str
    code_both: str
    # capacity attributes (pre-aggregated fan-out): (column, label)
    pole_yes: str
    pole_no: str
    capacity_labels: tuple[tuple[str, str], ...]
    # tri-state labels of a nullable boolean
    tri_true: str
    tri_false: str
    tri_null: str
    # registry attributes: plain casts (label, column), tri-state, doc count, areas, classes
    registry_scalars: tuple[tuple[str, str], ...]
    registry_tristate: tuple[str, str]
    registry_doc_count_label: str
    registry_area_labels: tuple[str, ...]
    registry_class_labels: tuple[tuple[str, str], ...]
    # bucket attributes emitted downstream (bucket column, label)
    bucket_labels: tuple[tuple[str, str], ...]
    vocab: ElementVocabulary = field(default_factory=ElementVocabulary)

    @classmethod
    def from_file(cls, path: str) -> SyncConfig:
        """Read a JSON object of these names; ``seed`` and ``vocab`` are objects, pairs are lists."""
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        unknown = sorted(set(given) - {x.name for x in fields(cls)})
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        given = {k: _tuples(v) for k, v in given.items()}
        given["seed"] = SeedDefaults(**given["seed"])
        if "vocab" in given:
            given["vocab"] = ElementVocabulary(**given["vocab"])
        return cls(**given)
