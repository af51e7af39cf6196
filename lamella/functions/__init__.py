"""Column to column expressions. No Python runs per row except in ``precision``."""
