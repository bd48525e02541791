"""Knowledge tables as plain Python values.

FIXED VALUES: everything in this module must equal the published labelling rules the
engine reproduces (allergen keywords, label orders, regulatory amounts, thresholds, claim
texts, classification patterns). They are stated here as data, in their natural order,
and turned into small DataFrames by ``labelcorpus.knowledge.dims``. Operators never read
this module directly: they take the dimension DataFrames (or these lists) as arguments,
so any other vocabulary can be swapped in.
"""

from __future__ import annotations

# --- fixed values: fortificant ingredient codes -------------------------------------------
FORTIFICANT_CODES = [
    "999301", "999303", "999328", "999401",
    "999431", "999418", "999001", "999291",
]

# --- fixed values: generic names (variety -> generic category), natural order -------------
GENERIC_NAMES = [
    ("Granny Smith", "APPLES"),
    ("Red Delicious", "APPLES"),
    ("Fuji", "APPLES"),
    ("Gala", "APPLES"),
    ("Honeycrisp", "APPLES"),
    ("Navel", "ORANGES"),
    ("Valencia", "ORANGES"),
    ("Cara Cara", "ORANGES"),
    ("Blood", "ORANGES"),
    ("Thompson seedless", "GRAPES"),
    ("Concord", "GRAPES"),
    ("Red seedless", "GRAPES"),
    ("Green seedless", "GRAPES"),
    ("Russet", "POTATOES"),
    ("Yukon Gold", "POTATOES"),
    ("Red potato", "POTATOES"),
    ("Red potatoes", "POTATOES"),
    ("Fingerling", "POTATOES"),
    ("Sweet potato", "SWEET POTATOES"),
    ("Sweet potatoes", "SWEET POTATOES"),
    ("Roma", "TOMATOES"),
    ("Beefsteak", "TOMATOES"),
    ("Cherry", "TOMATOES"),
    ("Grape tomato", "TOMATOES"),
    ("Grape tomatoes", "TOMATOES"),
    ("Heirloom", "TOMATOES"),
    ("Cos", "LETTUCE"),
    ("Iceberg", "LETTUCE"),
    ("Butter lettuce", "LETTUCE"),
    ("Cheddar", "CHEESE"),
    ("Mozzarella", "CHEESE"),
    ("Swiss", "CHEESE"),
    ("Provolone", "CHEESE"),
    ("Monterey Jack", "CHEESE"),
    ("Pepper Jack", "CHEESE"),
    ("Colby", "CHEESE"),
    ("Gouda", "CHEESE"),
    ("Havarti", "CHEESE"),
    ("Brie", "CHEESE"),
    ("Camembert", "CHEESE"),
    ("Gruyere", "CHEESE"),
    ("Feta", "CHEESE"),
    ("Blue cheese", "CHEESE"),
    ("Gorgonzola", "CHEESE"),
    ("Parmesan", "CHEESE"),
    ("Ricotta", "CHEESE"),
    ("Cottage", "COTTAGE CHEESE"),
]

# --- fixed values: compound ingredient recipes (compound -> [(sub, fraction)]) -----------
COMPOUNDS = [
    ("Chocolate", [("cocoa mass", 0.40), ("sugar", 0.40), ("cocoa butter", 0.15),
                   ("soy lecithin", 0.03), ("vanilla extract", 0.02)]),
    ("Milk Chocolate", [("sugar", 0.47), ("milk", 0.20), ("cocoa mass", 0.15),
                        ("cocoa butter", 0.15), ("soy lecithin", 0.02), ("vanilla extract", 0.01)]),
    ("White Chocolate", [("sugar", 0.45), ("cocoa butter", 0.25), ("milk", 0.22),
                         ("soy lecithin", 0.03), ("vanilla extract", 0.01), ("salt", 0.02)]),
    ("Ketchup", [("tomato concentrate", 0.60), ("sugar", 0.15), ("vinegar", 0.10),
                 ("salt", 0.04), ("spices", 0.01), ("water", 0.10)]),
    ("Mayonnaise", [("soybean oil", 0.65), ("egg yolk", 0.10), ("vinegar", 0.08),
                    ("water", 0.15), ("sugar", 0.01), ("salt", 0.01), ("lemon juice", 0.01)]),
    ("Mustard", [("vinegar", 0.40), ("water", 0.30), ("mustard seed", 0.18), ("salt", 0.05),
                 ("turmeric", 0.03), ("spices", 0.02)]),
    ("BBQ Sauce", [("tomato puree", 0.40), ("sugar", 0.25), ("vinegar", 0.15),
                   ("molasses", 0.10), ("spices", 0.05), ("salt", 0.02), ("smoke flavor", 0.01)]),
    ("Soy Sauce", [("water", 0.60), ("soybeans", 0.15), ("wheat", 0.10), ("salt", 0.10),
                   ("sugar", 0.03)]),
    ("Vinaigrette", [("vegetable oil", 0.50), ("vinegar", 0.30), ("water", 0.15),
                     ("salt", 0.02), ("spices", 0.02), ("sugar", 0.01)]),
    ("Pizza Sauce", [("tomato puree", 0.80), ("vegetable oil", 0.05), ("salt", 0.03),
                     ("sugar", 0.03), ("garlic", 0.02), ("oregano", 0.02), ("basil", 0.01)]),
    ("Enriched Flour", [("wheat flour", 0.985), ("niacin", 0.002), ("iron", 0.006),
                        ("thiamine mononitrate", 0.001), ("riboflavin", 0.001),
                        ("folic acid", 0.001)]),
    ("Bread Crumbs", [("wheat flour", 0.80), ("yeast", 0.05), ("sugar", 0.05), ("salt", 0.03),
                      ("vegetable oil", 0.02)]),
    ("Shortcrust Pastry", [("wheat flour", 0.45), ("butter", 0.30), ("water", 0.15),
                           ("sugar", 0.05), ("egg", 0.05)]),
    ("Puff Pastry", [("wheat flour", 0.35), ("butter", 0.45), ("water", 0.18), ("salt", 0.02)]),
    ("Seasoning Blend", [("salt", 0.30), ("spices", 0.25), ("sugar", 0.15),
                         ("dehydrated vegetables", 0.12), ("natural flavor", 0.08),
                         ("garlic powder", 0.05), ("onion powder", 0.05)]),
    ("Chicken Stock", [("water", 0.80), ("chicken", 0.10), ("vegetables", 0.05), ("salt", 0.02),
                       ("flavor", 0.01)]),
    ("Vegetable Stock", [("water", 0.85), ("vegetables", 0.10), ("salt", 0.02), ("spices", 0.01),
                         ("sugar", 0.01)]),
]

# --- fixed values: ingredient categories, first match wins (case-insensitive) ------------
INGREDIENT_CATEGORIES = [
    ("dairy", r"\b(milk|cream|cheese|yogurt|whey|butter|custard|buttermilk)\b"),
    ("egg", r"\b(egg|egg white|egg yolk|albumin)\b"),
    ("grain", r"\b(flour|wheat|rye|barley|oats|corn|rice|pasta|noodle|cracker|bread)\b"),
    ("sweetener", r"\b(sugar|syrup|honey|molasses|sucrose|fructose|glucose|dextrose|maltose"
                  r"|aspartame|stevia|splenda)\b"),
    ("oil_fat", r"\b(oil|shortening|lard|margarine|fat|tallow)\b"),
    ("fruit", r"\b(fruit|apple|banana|orange|grape|berry|lemon|strawberry)\b"),
    ("vegetable", r"\b(onion|garlic|tomato|carrot|celery|lettuce|broccoli|spinach|potato|corn"
                  r"|pea|bean)\b"),
    ("meat", r"\b(chicken|beef|pork|turkey|ham|bacon|lamb|veal|sausage|meat)\b"),
    ("seafood", r"\b(salmon|tuna|cod|shrimp|crab|lobster|fish|clam|mussel)\b"),
    ("nut", r"\b(almond|walnut|cashew|peanut|pecan|hazelnut|nut)\b"),
    ("herb_spice", r"\b(salt|pepper|cinnamon|oregano|basil|cumin|paprika|garlic powder"
                   r"|onion powder)\b"),
    ("additive", r"\b(lecithin|gum|xanthan|guar|carrageenan|cellulose|phosphate|citrate)\b"),
    ("water", r"\b(water|broth|stock|juice)\b"),
    ("legume", r"\b(soy|lentil|chickpea|tofu|edamame|miso)\b"),
    ("alcohol", r"\b(wine|beer|vodka|whiskey|rum|sherry|liqueur|alcohol|brandy)\b"),
]

# --- fixed values: allergen keywords (keyword -> allergen), natural order -----------------
ALLERGEN_KEYWORDS = [
    ("milk", "milk"), ("cream", "milk"), ("cheese", "milk"), ("yogurt", "milk"),
    ("whey", "milk"), ("butter", "milk"), ("buttermilk", "milk"), ("custard", "milk"),
    ("lactose", "milk"), ("casein", "milk"),
    ("egg", "eggs"), ("egg white", "eggs"), ("egg yolk", "eggs"), ("albumin", "eggs"),
    ("albumen", "eggs"),
    ("salmon", "fish"), ("tuna", "fish"), ("cod", "fish"), ("fish", "fish"),
    ("anchovy", "fish"), ("sardine", "fish"),
    ("shrimp", "crustacean shellfish"), ("crab", "crustacean shellfish"),
    ("lobster", "crustacean shellfish"), ("crawfish", "crustacean shellfish"),
    ("prawn", "crustacean shellfish"),
    ("almond", "tree nuts"), ("walnut", "tree nuts"), ("cashew", "tree nuts"),
    ("pecan", "tree nuts"), ("hazelnut", "tree nuts"), ("macadamia", "tree nuts"),
    ("pistachio", "tree nuts"), ("pine nut", "tree nuts"),
    ("peanut", "peanuts"), ("groundnut", "peanuts"),
    ("wheat", "wheat"), ("gluten", "wheat"), ("semolina", "wheat"), ("spelt", "wheat"),
    ("soy", "soybeans"), ("soybean", "soybeans"), ("tofu", "soybeans"),
    ("edamame", "soybeans"), ("miso", "soybeans"), ("tempeh", "soybeans"),
    ("sesame", "sesame"), ("tahini", "sesame"), ("benne", "sesame"),
]

# --- fixed values: an ingredient matching any of these is skipped for allergens -----------
ALLERGEN_EXCLUSIONS = [r"\bcream\s+of\s+tartar\b"]

# --- fixed values: allergen declaration order ---------------------------------------------
ALLERGEN_ORDER = [
    "milk", "eggs", "fish", "crustacean shellfish", "tree nuts",
    "peanuts", "wheat", "soybeans", "sesame",
]

# --- fixed values: RACC (category, grams, millilitres, label statement, household) -------
RACC = [
    ("breads_rolls", 50, 0, "1 slice", "1 slice (__g)"),
    ("cakes_cookies", 80, 0, "1 piece", "1 piece (__g)"),
    ("crackers", 30, 0, "about __ crackers", "__ crackers (__g)"),
    ("bakery_products", 55, 0, "1 serving", "1 serving (__g)"),
    ("pastries", 80, 0, "1 pastry", "1 pastry (__g)"),
    ("milk", 0, 240, "1 cup", "1 cup (__ml)"),
    ("yogurt", 170, 0, "1 container", "1 container (__g)"),
    ("cheese", 30, 0, "1 oz", "about 1 oz (__g)"),
    ("butter", 14, 0, "1 tbsp", "1 tbsp (__g)"),
    ("cream", 0, 15, "1 tbsp", "1 tbsp (__ml)"),
    ("ice_cream", 85, 0, "1 scoop", "about 1/2 cup (__g)"),
    ("beverages_carbonated", 0, 360, "1 bottle", "1 bottle (__ml)"),
    ("juice", 0, 240, "1 cup", "1 cup (__ml)"),
    ("coffee_tea", 0, 240, "1 cup", "1 cup (__ml)"),
    ("dairy_drinks", 0, 240, "1 cup", "1 cup (__ml)"),
    ("fresh_fruit", 140, 0, "1 medium", "1 medium (__g)"),
    ("canned_fruit", 125, 0, "1/2 cup", "about 1/2 cup (__g)"),
    ("dried_fruit", 40, 0, "1/4 cup", "about 1/4 cup (__g)"),
    ("fresh_vegetables", 85, 0, "1 cup", "1 cup (__g)"),
    ("canned_vegetables", 125, 0, "1/2 cup", "about 1/2 cup (__g)"),
    ("meat_poultry", 85, 0, "3 oz", "about 3 oz (__g)"),
    ("fish_seafood", 85, 0, "3 oz", "about 3 oz (__g)"),
    ("eggs", 50, 0, "1 large egg", "1 large egg (__g)"),
    ("nuts_seeds", 30, 0, "1 oz", "about 1 oz (__g)"),
    ("tofu_meat_alternatives", 85, 0, "3 oz", "about 3 oz (__g)"),
    ("rice_pasta", 140, 0, "1 cup cooked", "about 1 cup (__g)"),
    ("breakfast_cereals", 40, 0, "1 cup", "about 1 cup (__g)"),
    ("oatmeal", 240, 0, "1 cup cooked", "about 1 cup (__g)"),
    ("oils", 14, 0, "1 tbsp", "1 tbsp (__g)"),
    ("salad_dressings", 30, 0, "2 tbsp", "2 tbsp (__g)"),
    ("mayonnaise", 14, 0, "1 tbsp", "1 tbsp (__g)"),
    ("spreads", 14, 0, "1 tbsp", "1 tbsp (__g)"),
    ("condiments", 14, 0, "1 tbsp", "1 tbsp (__g)"),
    ("sauces", 30, 0, "2 tbsp", "2 tbsp (__g)"),
    ("gravies", 30, 0, "2 tbsp", "2 tbsp (__g)"),
    ("jams_jellies", 20, 0, "1 tbsp", "1 tbsp (__g)"),
    ("chips_crisps", 30, 0, "about __ chips", "about __ chips (__g)"),
    ("popcorn", 30, 0, "1 cup", "about 1 cup (__g)"),
    ("candy", 40, 0, "about __ pieces", "about __ pieces (__g)"),
    ("chocolate", 40, 0, "1 bar", "1 bar (__g)"),
    ("granola_bars", 40, 0, "1 bar", "1 bar (__g)"),
    ("soup_ready_to_eat", 245, 0, "1 cup", "about 1 cup (__g)"),
    ("soup_condensed", 120, 0, "1/2 cup condensed", "about 1/2 cup (__g)"),
    ("frozen_meals", 270, 0, "1 meal", "1 meal (__g)"),
    ("frozen_pizza", 135, 0, "1 slice", "1 slice (__g)"),
    ("frozen_desserts", 85, 0, "1 serving", "about 1/2 cup (__g)"),
    ("baby_food", 60, 0, "1 jar", "1 jar (__g)"),
    ("beverage_mixes", 20, 0, "1 packet", "1 packet (__g)"),
]
# The 49th category has no RACC row.
UNCATEGORIZED = "uncategorized"

# --- fixed values: food-code prefix -> category ------------------------------------------
CODE_PREFIXES = [
    ("11", "milk"), ("12", "milk"), ("13", "milk"), ("14", "cheese"),
    ("21", "meat_poultry"), ("22", "meat_poultry"), ("23", "meat_poultry"),
    ("24", "meat_poultry"), ("25", "fish_seafood"), ("26", "fish_seafood"), ("27", "eggs"),
    ("31", "fresh_fruit"), ("32", "canned_fruit"), ("33", "dried_fruit"),
    ("34", "fresh_vegetables"), ("35", "canned_vegetables"),
    ("41", "bakery_products"), ("42", "bakery_products"), ("43", "bakery_products"),
    ("44", "bakery_products"),
    ("51", "rice_pasta"), ("52", "rice_pasta"), ("53", "breakfast_cereals"),
    ("54", "breakfast_cereals"), ("55", "breakfast_cereals"), ("56", "breakfast_cereals"),
    ("57", "bakery_products"), ("58", "soup_ready_to_eat"),
    ("61", "fresh_vegetables"), ("62", "fresh_vegetables"), ("63", "fresh_vegetables"),
    ("64", "fresh_vegetables"),
    ("71", "chips_crisps"), ("72", "chips_crisps"), ("73", "candy"), ("74", "uncategorized"),
    ("75", "salad_dressings"), ("76", "condiments"), ("77", "spreads"),
    ("81", "beverages_carbonated"), ("82", "juice"), ("83", "beverages_carbonated"),
    ("84", "coffee_tea"), ("85", "beverages_carbonated"),
    ("91", "fish_seafood"), ("92", "fish_seafood"), ("93", "uncategorized"),
]

# --- fixed values: food-name keyword patterns, first match wins (case-insensitive) -------
FOOD_NAME_KEYWORDS = [
    (r"\b(bread|roll|bagel|toast|bun)\b", "breads_rolls"),
    (r"\b(cake|cookie|brownie|donut|doughnut|muffin|cupcake)\b", "cakes_cookies"),
    (r"\b(cracker|pretzel|rice cake)\b", "crackers"),
    (r"\b(pie|croissant|danish|turnover)\b", "pastries"),
    (r"\b(milk|buttermilk|evaporated|condensed)\b", "milk"),
    (r"\b(yogurt|yoghurt)\b", "yogurt"),
    (r"\b(cheese|cheddar|mozzarella|swiss|provolone)\b", "cheese"),
    (r"\b(butter|margarine)\b", "butter"),
    (r"\b(ice cream|gelato|sorbet|frozen yogurt)\b", "ice_cream"),
    (r"\b(juice|nectar|fruit drink)\b", "juice"),
    (r"\b(soda|cola|ginger ale|seltzer|tonic|pop)\b", "beverages_carbonated"),
    (r"\b(coffee|tea|latte|cappuccino|espresso)\b", "coffee_tea"),
    (r"\b(fruit|apple|banana|orange|grape|berry|berries)\b", "fresh_fruit"),
    (r"\b(chicken|beef|pork|turkey|ham|bacon|sausage|meat)\b", "meat_poultry"),
    (r"\b(salmon|tuna|cod|shrimp|crab|lobster|fish)\b", "fish_seafood"),
    (r"\b(egg|omelet|omelette)\b", "eggs"),
    (r"\b(almond|walnut|peanut|cashew|nut|seed)\b", "nuts_seeds"),
    (r"\b(cereal|granola)\b", "breakfast_cereals"),
    (r"\b(oatmeal|porridge|oat)\b", "oatmeal"),
    (r"\b(rice|pasta|spaghetti|noodle|macaroni)\b", "rice_pasta"),
    (r"\b(chip|fry|fries|crisp|tortilla chip|potato chip)\b", "chips_crisps"),
    (r"\b(candy|chocolate|bonbon|toffee|caramel)\b", "candy"),
    (r"\b(soup|broth|stock|bisque)\b", "soup_ready_to_eat"),
    (r"\b(dressing|vinagrette|dip)\b", "salad_dressings"),
    (r"\b(ketchup|mustard|mayonnaise|relish|salsa|soy sauce|hot sauce)\b", "condiments"),
    (r"\b(jam|jelly|preserve|marmalade|honey|syrup)\b", "jams_jellies"),
    (r"\b(pizza)\b", "frozen_pizza"),
    (r"\b(baby|infant|toddler)\b", "baby_food"),
    (r"\b(protein|energy|granola) bar\b", "granola_bars"),
]

# --- fixed values: daily values (DV key -> amount) ----------------------------------------
DAILY_VALUES = [
    ("Total Fat", 78), ("Saturated Fat", 20), ("Cholesterol", 300), ("Sodium", 2300),
    ("Total Carbohydrate", 275), ("Dietary Fiber", 28), ("Protein", 50), ("Vitamin D", 20),
    ("Calcium", 1300), ("Iron", 18), ("Potassium", 4700), ("Vitamin A", 900),
    ("Vitamin C", 90), ("Vitamin E", 15), ("Vitamin K", 120), ("Thiamin (Vitamin B1)", 1.2),
    ("Riboflavin (Vitamin B2)", 1.3), ("Niacin (Vitamin B3)", 16), ("Vitamin B6", 1.7),
    ("Vitamin B12", 2.4), ("Folate", 400), ("Magnesium", 420), ("Zinc", 11),
    ("Chloride", 2300), ("Manganese", 2.3), ("Selenium", 55), ("Iodine", 150),
    ("Phosphorus", 1250), ("Molybdenum", 45), ("Biotin", 30), ("Pantothenic Acid", 5),
    ("Added Sugars", 50),
]

# --- fixed values: survey nutrient name -> DV key (identity when absent) -----------------
NUTRIENT_DV_KEYS = [
    ("Total lipid (fat)", "Total Fat"),
    ("Fatty acids, total saturated", "Saturated Fat"),
    ("Fatty acids, total trans", "Trans Fat"),
    ("Cholesterol", "Cholesterol"),
    ("Sodium, Na", "Sodium"),
    ("Carbohydrate, by difference", "Total Carbohydrate"),
    ("Fiber, total dietary", "Dietary Fiber"),
    ("Total Sugars", "Total Sugars"),
    ("Sugars, added", "Added Sugars"),
    ("Protein", "Protein"),
    ("Vitamin D (D2 + D3)", "Vitamin D"),
    ("Calcium, Ca", "Calcium"),
    ("Iron, Fe", "Iron"),
    ("Potassium, K", "Potassium"),
]

# --- fixed values: claim groups -> survey nutrient name (fiber has no content claim) -----
CLAIM_GROUPS = [
    ("fat", "Total lipid (fat)"),
    ("saturated_fat", "Fatty acids, total saturated"),
    ("cholesterol", "Cholesterol"),
    ("sodium", "Sodium, Na"),
    ("sugar", "Total Sugars"),
    ("energy", "Energy"),
    ("fiber", "Fiber, total dietary"),
]

# --- fixed values: content-claim thresholds --------------------------------------------
# (group, claim id, per serving, per 100 g, per 100 g solid, per 100 g liquid); None = absent
CONTENT_CLAIMS = [
    ("fat", "fat_free", 0.5, None, None, None),
    ("fat", "low_fat", None, None, 3.0, 1.5),
    ("fat", "reduced_fat", None, None, None, None),
    ("saturated_fat", "saturated_fat_free", 0.5, None, None, None),
    ("saturated_fat", "low_saturated_fat", 1.0, None, 1.0, None),
    ("cholesterol", "cholesterol_free", 2, None, None, None),
    ("cholesterol", "low_cholesterol", None, None, 20, 10),
    ("sodium", "sodium_free", 5, None, None, None),
    ("sodium", "very_low_sodium", None, 35, None, None),
    ("sodium", "low_sodium", None, 140, None, None),
    ("sugar", "sugar_free", 0.5, None, None, None),
    ("sugar", "no_added_sugar", None, None, None, None),
    ("energy", "calorie_free", 5, None, None, None),
    ("energy", "low_calorie", None, 40, None, None),
]

# --- fixed values: claim texts (claim id -> text) ------------------------------------------
CLAIM_TEXTS = [
    ("fat_free", "FAT FREE"),
    ("low_fat", "LOW FAT"),
    ("reduced_fat", "{percent}% REDUCED FAT"),
    ("saturated_fat_free", "SATURATED FAT FREE"),
    ("low_saturated_fat", "LOW SATURATED FAT"),
    ("cholesterol_free", "CHOLESTEROL FREE"),
    ("low_cholesterol", "LOW CHOLESTEROL"),
    ("sodium_free", "SODIUM FREE"),
    ("very_low_sodium", "VERY LOW SODIUM"),
    ("low_sodium", "LOW SODIUM"),
    ("sugar_free", "SUGAR FREE"),
    ("no_added_sugar", "NO ADDED SUGAR"),
    ("calorie_free", "CALORIE FREE"),
    ("low_calorie", "LOW CALORIE"),
    ("good_source_fiber", "GOOD SOURCE OF FIBER"),
    ("excellent_source_fiber", "EXCELLENT SOURCE OF FIBER"),
]

# --- fixed values: nutrients eligible for good/excellent source claims -------------------
SOURCE_NUTRIENTS = [
    ("Protein", "PROTEIN"),
    ("Fiber, total dietary", "DIETARY FIBER"),
    ("Vitamin D (D2 + D3)", "VITAMIN D"),
    ("Calcium, Ca", "CALCIUM"),
    ("Iron, Fe", "IRON"),
    ("Potassium, K", "POTASSIUM"),
]

# --- fixed values: health claims (nutrient, comparison, per-serving threshold, text) -----
HEALTH_CLAIMS = [
    ("Calcium, Ca", "above", 200,
     "Adequate calcium throughout life may reduce the risk of osteoporosis."),
    ("Sodium, Na", "below", 140,
     "Diets low in sodium may reduce the risk of high blood pressure."),
    ("Total lipid (fat)", "below", 6.5,
     "Diets low in total fat may reduce the risk of some cancers."),
    ("Fatty acids, total saturated", "below", 4,
     "Diets low in saturated fat and cholesterol may reduce the risk of coronary heart disease."),
    ("Fiber, total dietary", "above", 2.8,
     "Diets low in fat and rich in fiber may reduce the risk of some cancers."),
    ("Potassium, K", "above", 470,
     "Diets containing foods that are a good source of potassium may reduce the risk of high "
     "blood pressure."),
]

# --- fixed values: words that make a claim 'nutrient_content' (else 'health') -------------
CONTENT_CLAIM_WORDS = ["source", "free", "low", "reduced"]

# --- fixed values: substrings of a lower-cased food name that mark it liquid -------------
LIQUID_WORDS = ["milk", "juice", "beverage", "broth", "soup", "drink"]

# --- fixed values: prohibited label terms (case-insensitive regexes) ----------------------
PROHIBITED_TERMS = [
    r"\bnatural\b",
    r"\bwholesome\b",
    r"\bhealthful\b",
    r"\borganic\b",
    r"\bcure\b",
    r"\bmiracle\b",
    r"\bguaranteed\b",
    r"\b100%\s*(natural|pure|organic)\b",
]

# --- fixed values: panel nutrient rows (display, survey name, unit) in panel order -------
PANEL_ROWS = [
    ("Total Fat", "Total lipid (fat)", "g"),
    ("  Saturated Fat", "Fatty acids, total saturated", "g"),
    ("  Trans Fat", "Fatty acids, total trans", "g"),
    ("Cholesterol", "Cholesterol", "mg"),
    ("Sodium", "Sodium, Na", "mg"),
    ("Total Carbohydrate", "Carbohydrate, by difference", "g"),
    ("  Dietary Fiber", "Fiber, total dietary", "g"),
    ("  Total Sugars", "Total Sugars", "g"),
    ("  Includes Added Sugars", "Sugars, added", "g"),
    ("Protein", "Protein", "g"),
]
PANEL_VITAMINS = [
    ("Vitamin D", "Vitamin D (D2 + D3)"),
    ("Calcium", "Calcium, Ca"),
    ("Iron", "Iron, Fe"),
    ("Potassium", "Potassium, K"),
]
# Nutrients whose %DV is stored on the panel, in order.
PANEL_DV_NUTRIENTS = [
    "Total lipid (fat)", "Fatty acids, total saturated", "Cholesterol", "Sodium, Na",
    "Carbohydrate, by difference", "Fiber, total dietary", "Protein", "Vitamin D (D2 + D3)",
    "Calcium, Ca", "Iron, Fe", "Potassium, K",
]
# Panel columns (column name, survey nutrient name).
PANEL_COLUMNS = [
    ("calories", "Energy"),
    ("total_fat", "Total lipid (fat)"),
    ("saturated_fat", "Fatty acids, total saturated"),
    ("trans_fat", "Fatty acids, total trans"),
    ("cholesterol", "Cholesterol"),
    ("sodium", "Sodium, Na"),
    ("total_carbohydrate", "Carbohydrate, by difference"),
    ("dietary_fiber", "Fiber, total dietary"),
    ("total_sugars", "Total Sugars"),
    ("added_sugars", "Sugars, added"),
    ("protein", "Protein"),
    ("vitamin_d", "Vitamin D (D2 + D3)"),
    ("calcium", "Calcium, Ca"),
    ("iron", "Iron, Fe"),
    ("potassium", "Potassium, K"),
]
PANEL_FOOTER = (
    "* The % Daily Value tells you how much a nutrient in a serving of food contributes to a "
    "daily diet. 2,000 calories a day is used for general nutrition advice."
)

# --- rounding steps (21 CFR 101.9(c)); only the energy step is confirmed by a test -------
# (nutrient, zero below, fine step, fine step applies up to and incl., coarse step)
ROUNDING = [
    ("Energy", 5, 5, 50, 10),
    ("Total lipid (fat)", 0.5, 0.5, 5, 1),
    ("Fatty acids, total saturated", 0.5, 0.5, 5, 1),
    ("Fatty acids, total trans", 0.5, 0.5, 5, 1),
    ("Cholesterol", 2, 5, None, 5),
    ("Sodium, Na", 5, 5, 140, 10),
    ("Carbohydrate, by difference", 0.5, 1, None, 1),
    ("Fiber, total dietary", 0.5, 1, None, 1),
    ("Total Sugars", 0.5, 1, None, 1),
    ("Sugars, added", 0.5, 1, None, 1),
    ("Protein", 0.5, 1, None, 1),
    ("Vitamin D (D2 + D3)", None, 0.1, None, 0.1),
    ("Calcium, Ca", None, 10, None, 10),
    ("Iron, Fe", None, 0.1, None, 0.1),
    ("Potassium, K", None, 10, None, 10),
]

# --- fixed values: ground-truth mapping namespaces ----------------------------------------
CODE_NAMESPACE = "usda_fndds_ingredient_code"
DESCRIPTION_NAMESPACE = "usda_fndds_ingredient_description"

# --- operator names, order and difficulty levels -----------------------------------------
OPERATORS = [
    ("rename", 1), ("generic_name", 1), ("compound", 2), ("less_than_2_pct", 2),
    ("allergen", 1), ("claim", 2), ("nutrition_facts", 1),
]
OPERATOR_VERSION = "1.0"
DIFFICULTY_NAMES = [(1, "EASY"), (2, "MEDIUM"), (3, "HARD")]
