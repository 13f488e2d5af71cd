"""DataFrame -> DataFrame steps of the Bronze, Silver and Gold layers."""
