"""Clinical specs and the compositions of operators that use them."""
