"""Operations of a training-data pipeline; nothing else in the library imports this package."""

from __future__ import annotations
