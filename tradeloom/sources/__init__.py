"""Where the tables come from and how they are laid out."""
