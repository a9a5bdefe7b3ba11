"""Multi-step tables and jobs made from the operators."""
