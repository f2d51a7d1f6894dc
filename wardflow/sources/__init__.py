"""Message files, message buses, tables and publishing targets."""
