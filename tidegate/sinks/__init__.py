"""Writers: definition texts and catalog CSV."""
