"""All registered queries by name."""

from __future__ import annotations

from icufeat.checks import clinical, evaluation, features, modelling
from icufeat.checks.base import Check

CHECKS: dict[str, Check] = {**clinical.CHECKS, **features.CHECKS, **evaluation.CHECKS, **modelling.CHECKS}
