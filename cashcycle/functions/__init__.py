"""Column-level building blocks: report periods and measure expressions."""
