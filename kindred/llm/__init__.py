"""Operations of a training-data pipeline (one module per operator).

Nothing else in the library imports this subpackage.  Its Python helpers travel
inside the tasks that use them, so executors need no copy of the package.
"""

import sys

from kindred._shipping import ship_by_value

ship_by_value(sys.modules[__name__])
