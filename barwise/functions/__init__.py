"""Column helpers.  Every function takes and returns ``Column`` objects and
compiles to built-in Catalyst expressions, so they stay inside whole-stage
codegen; none of them can raise at run time under ANSI mode."""

from barwise.functions.scalar import *  # noqa: F401,F403
from barwise.functions.scalar import __all__  # noqa: F401
