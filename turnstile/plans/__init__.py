"""turnstile.plans"""
