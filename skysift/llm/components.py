"""Connected components, as the corpus operators use them."""

from skysift.operators.components import components  # noqa: F401
