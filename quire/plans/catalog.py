"""Imports every plan module so that their queries register."""

from quire.plans import corpus  # noqa: F401
from quire.plans import keywords  # noqa: F401
from quire.plans import vectors  # noqa: F401
from quire.plans import models  # noqa: F401
from quire.plans import io  # noqa: F401
