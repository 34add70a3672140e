"""Part of caseloom."""
