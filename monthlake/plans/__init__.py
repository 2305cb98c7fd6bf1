"""Layer plans: bronze staging, silver dimensions and fact, gold mart, whole run."""
