"""What runs when: configuration, manifests and the registered queries."""
