"""Imports every query module so that their ``register`` calls run."""
from . import clinical  # noqa: F401
from . import profiling  # noqa: F401
from . import splits  # noqa: F401
from . import metrics  # noqa: F401
from . import modeling  # noqa: F401
from . import streams  # noqa: F401
