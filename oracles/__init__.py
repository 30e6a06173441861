"""DuckDB oracle texts keyed like ``queries()``; written independently of the Spark plans."""
from .catalog import ORACLE_SQL  # noqa: F401
from . import profiling  # noqa: F401,E402
from . import splits  # noqa: F401,E402
from . import metrics  # noqa: F401,E402
from . import modeling  # noqa: F401,E402
