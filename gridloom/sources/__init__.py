"""Reading tables and writing them back."""
